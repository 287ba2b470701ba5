"""Flag expressions over the columns of one row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from plumbline.config import GrossRange, QueryRule
from plumbline.schema import BAD_VALUE, FAIL, FLAG_TEXT, GOOD, MISSING, SUSPECT


def gross_range(value: Column, spans: GrossRange) -> Column:
    """MISSING, FAIL outside the fail span, SUSPECT outside the suspect span; span ends are good."""
    return (
        F.when(value.isNull(), MISSING)
        .when(~value.between(*map(float, spans.fail)), FAIL)
        .when(~value.between(*map(float, spans.suspect)), SUSPECT)
        .otherwise(GOOD)
    )


def bad_value(value: Column, mapping: Sequence[tuple[int, Sequence[float]]] = ((FAIL, (BAD_VALUE,)),)) -> Column:
    """MISSING for NULL or NaN, the mapped code for listed values (a later entry wins), else GOOD."""
    flag = F.when(value.isNull() | F.isnan(value), MISSING)
    for code, values in reversed(mapping):
        flag = flag.when(value.isin(*values), code)
    return flag.otherwise(GOOD)


def without_bad_values(value: Column, values: Sequence[float] = (BAD_VALUE,)) -> Column:
    return F.when(value.isin(*values) | F.isnan(value), None).otherwise(value)


def query_flag(column: str, rules: Iterable[QueryRule]) -> Column:
    """GOOD, or the value of the last rule that names this column and holds."""
    named = [r for r in rules if column in r.columns]
    last, *earlier = reversed(named)
    chain = reduce(lambda c, r: c.when(F.expr(r.predicate), r.value), earlier, F.when(F.expr(last.predicate), last.value))
    return chain.otherwise(GOOD)


def text_to_code(text: Column) -> Column:
    """Level-1 code of a text flag; unknown texts give NULL."""
    pairs = [F.lit(x) for code, word in FLAG_TEXT.items() for x in (word, code)]
    return F.create_map(*pairs)[text]


# The next two name a dozen columns for each of a dozen variables. As one SQL text each they reach the
# JVM in one call instead of hundreds, which makes building the plan of a run noticeably cheaper.


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# ``terms`` has the SQL of columns that are packed; ``at`` the words and bits of those that are just parts of a word.
# Of the codes only 4 has the bit 4, only 3 the bits 1 and 2, and 1 has neither 2 nor 8 besides its own bit, so
# whether any of many columns has a code takes a few operations on their words.
_HAS = {FAIL: "({w} & {m}) != 0", SUSPECT: "({w} & shiftright({w}, 1) & {m}) != 0",
        GOOD: "({w} & ~shiftright({w}, 1) & ~shiftright({w}, 3) & {m}) != 0"}

Places = Mapping[str, tuple[str, int]]


def _any(code: int, sources: Sequence[str], terms: Mapping[str, str], at: Places) -> str:
    """SQL of whether any of the columns has the code; not true where none has it."""
    masks: dict[str, int] = {}
    for word, bit in (at[c] for c in sources if c in at):
        masks[word] = masks.get(word, 0) | (FAIL if code == FAIL else 1) << bit
    loose = [f"{terms.get(c, _quoted(c))} = {code}" for c in sources if c not in at]
    return " OR ".join([*[f"({_HAS[code].format(w=_quoted(w), m=f'{m}L')})" for w, m in masks.items()], *loose])


def worst(sources: Sequence[str], terms: Mapping[str, str] | None = None, at: Places | None = None) -> Column:
    """Worst of the codes 1 < 3 < 4 in the named columns; other codes do not count. NULL when none counts."""
    if at:
        cases = [f"WHEN {_any(code, sources, terms or {}, at)} THEN {code}" for code in (FAIL, SUSPECT, GOOD)]
        return F.expr(f"CASE {' '.join(cases)} END")
    found = [(terms or {}).get(c, _quoted(c)) for c in sources]
    counted = [f"IF({c} IN ({GOOD}, {SUSPECT}, {FAIL}), {c}, NULL)" for c in found]
    return F.expr(f"greatest({', '.join(counted)})" if len(counted) > 1 else counted[0])


def found(sources: Sequence[str], terms: Mapping[str, str], at: Places) -> Column:
    """Whether ``findings`` of the columns has a text; not true where it has none."""
    return F.expr(" OR ".join(_any(code, sources, terms, at) for code in (FAIL, SUSPECT)) if sources else "false")


def findings(sources: Sequence[str], terms: Mapping[str, str] | None = None) -> Column:
    """Text of the tests that failed or are suspect: failures first, names in descending order."""
    parts = []
    for code in (FAIL, SUSPECT):
        for name in sorted(sources, reverse=True):
            text = f"{FLAG_TEXT[code]}: {name}".replace("\\", "\\\\").replace("'", "\\'")
            parts.append(f"IF({(terms or {}).get(name, _quoted(name))} = {code}, '{text}', NULL)")
    return F.expr(f"nullif(concat_ws('; ', {', '.join(parts)}), '')")


CODES_PER_WORD = 15  # codes are below 16


def packed(codes: Mapping[str, Column], name: str, optional: bool = False) -> dict[str, Column]:
    """Several codes in a few whole numbers, so that rows are narrower where they are moved and sorted.

    ``optional``: codes may be NULL.
    """
    if optional:
        codes = {n: F.coalesce(c, F.lit(0)) for n, c in codes.items()}
    words, columns = {}, list(codes.values())
    for at in range(0, len(columns), CODES_PER_WORD):
        parts = [F.shiftleft(c.cast("long"), 4 * i) for i, c in enumerate(columns[at : at + CODES_PER_WORD])]
        words[f"{name}_{at // CODES_PER_WORD}"] = reduce(Column.bitwiseOR, parts)
    return words


def places(columns: Sequence[str], name: str) -> dict[str, tuple[str, int]]:
    """The word and the bit where ``packed`` put each column."""
    return {c: (f"{name}_{i // CODES_PER_WORD}", 4 * (i % CODES_PER_WORD)) for i, c in enumerate(columns)}


def unpacked(columns: Sequence[str], name: str, optional: bool = False) -> dict[str, str]:
    """SQL of the columns that ``packed`` put into words of this name."""
    codes = {c: f"CAST(shiftright({_quoted(w)}, {bit}) & 15 AS INT)" for c, (w, bit) in places(columns, name).items()}
    return {c: f"nullif({code}, 0)" for c, code in codes.items()} if optional else codes

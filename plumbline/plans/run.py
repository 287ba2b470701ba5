"""The whole quality-control run over a set of casts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from plumbline.config import QCConfig
from plumbline.functions import flags
from plumbline.operators import aggregate, casttests, greylist, layout, profiletests, rowtests
from plumbline.operators.lookups import written
from plumbline.schema import CAST, GOOD, MEASURED_AT, STATIC_TIME
from plumbline.sources.stored import StoredCasts


def attach_manual_qc(df: DataFrame, manual_qc: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Codes of the manual review on every row of the cast; NULL for casts without a review."""
    codes = casttests.folded(casttests.manual_qc_codes(manual_qc), CAST)
    return layout.per_cast(df, lambda part: part, max_rows, tables=[codes])


def run_qc(
    data: DataFrame | StoredCasts,
    stations: DataFrame,
    metadata: DataFrame | None = None,
    manual_qc: DataFrame | None = None,
    grey: DataFrame | None = None,
    cfg: QCConfig | None = None,
    time: str = MEASURED_AT,
    max_rows: int | None = None,
) -> DataFrame:
    """All tests, aggregated flags, overrides. Order of the steps matters and is fixed.

    ``data`` may be rows stored by cast, which are then not moved.

    ``time`` is the clock of the rate-of-change test. ``max_rows`` is the size above which a cast is cut.
    """
    cfg = cfg or QCConfig()
    table = data if isinstance(data, DataFrame) else data.rows()
    tested = [v for v in cfg.tested() if v in table.columns]
    tests = {v: cfg.variables[v] for v in tested}
    attenuated = {v: t.attenuated for v, t in tests.items() if t.attenuated}
    light = "par" in tested

    # Row by row, in the scan's stage, before values that later steps need not see.
    def clean(df: DataFrame) -> DataFrame:
        return rowtests.null_sentinels(rowtests.bad_value(layout.assign_qc_group(df), tested))

    def row_tests(df: DataFrame) -> DataFrame:
        out = rowtests.gross_range(clean(df), {v: t.gross_range for v, t in tests.items() if t.gross_range})
        return rowtests.query_flags(out, cfg.query_rules) if rules_early else out

    grouped, rows = layout.assign_qc_group(table), clean(table)
    rules_early = _resolves(rows, cfg)

    # One row per cast from everything that is decided by cast; every log row and review of a cast counts.
    facts = []
    if any(v in tested for v in cfg.do_cap.variables):
        facts.append(casttests.do_cap_facts(rows, cfg.do_cap))
    if metadata is not None:
        facts.append(casttests.code_facts(casttests.process_log_flags(metadata)))
    if manual_qc is not None:
        facts.append(casttests.code_facts(casttests.manual_qc_codes(manual_qc)))
    cast_codes = [c for f in facts for c in f.columns]
    cast_words = flags.packed({c: F.col(f"`{c}`") for c in cast_codes}, "qc_cast_codes", optional=True)
    casts = casttests.by_cast(profiletests.profile_facts(rows, attenuated, "par" if light else None), *facts)
    at_stations = casttests.by_cast(casttests.station_facts(rows, stations, cfg.station_depth))
    # Written, as it also tells which casts are large.
    casts = written(casts.withColumns(cast_words).drop(*cast_codes).join(at_stations, CAST, "left"), "casts")

    # The codes so far are packed, so that rows are narrow where they are moved, sorted and windowed.
    codes = [c for c in row_tests(table).columns if c not in grouped.columns]
    words = flags.packed({c: F.col(c) for c in codes}, "qc_codes")
    terms = flags.unpacked(codes, "qc_codes")

    def packed(df: DataFrame) -> DataFrame:
        return row_tests(df).withColumns(words).drop(*codes)

    coded = packed(data) if isinstance(data, DataFrame) else data.map(packed)

    def unpacked(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.expr(term) for c, term in terms.items()}).drop(*words)

    rates = {v: t.rate_of_change for v, t in tests.items() if t.rate_of_change}
    rate_codes = [f"{v}_qartod_rate_of_change_test" for v in rates]
    rate_words = flags.packed({c: F.col(c) for c in rate_codes}, "qc_rate_codes")
    # Tests and rules of the user's own name columns.
    named = bool(cfg.user_tests) or not rules_early

    def whole_casts(part: DataFrame) -> DataFrame:
        out = profiletests.neighbour_tests(part, rates, {v: t.inversion for v, t in tests.items() if t.inversion}, time)
        if not named:
            out = out.withColumns(rate_words).drop(*rate_codes)
        if "sigma0" in tested:
            out = profiletests.bottom_hit(out)
        if light:
            out = layout.max_from_bottom(out, "par", "qc_deeper_max", source=part)
        return layout.with_user_tests(unpacked(out), cfg.user_tests) if cfg.user_tests else out

    out = layout.per_cast(coded, whole_casts, max_rows, sized=casts, tables=[casts.drop(layout.ROWS)]).drop(STATIC_TIME)

    # Row by row again, behind the shuffle; the rules are joined while rows are narrow.
    if grey is not None:
        predicates = greylist.rule_predicates(grey)
        out = greylist.with_rules(out, grey, predicates, source=grouped)
    terms = {} if cfg.user_tests else terms
    valued = {v: f"{terms.get(f'{v}_hakai_bad_value_test', f'{v}_hakai_bad_value_test')} = {GOOD}" for v in tested}
    out, attenuated_words, attenuated_terms = profiletests.attenuated_flags(out, attenuated, valued)
    out = profiletests.shadow_flag(out, "par", cfg.par_shadow_min) if light else out.drop("qc_any")
    out = casttests.at_station(out)
    terms = terms | attenuated_terms | flags.unpacked(cast_codes, "qc_cast_codes", optional=True)
    at = flags.places(codes, "qc_codes") | flags.places(cast_codes, "qc_cast_codes")
    packs = [c for c in [*words, *cast_words, *attenuated_words] if c in out.columns]
    if not named:
        terms |= flags.unpacked(rate_codes, "qc_rate_codes")
        at |= flags.places(rate_codes, "qc_rate_codes")
        packs += rate_words

    def columns(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.expr(term) for c, term in terms.items()}).drop(*packs)

    if named:
        out, terms, at = columns(out), {}, {}
        valued = {v: f"{v}_hakai_bad_value_test = {GOOD}" for v in tested}
    if not rules_early:
        out = rowtests.query_flags(out, cfg.query_rules)
    names = [c for c in [*out.columns, *terms] if c not in packs]
    valued = {v: F.expr(c) for v, c in valued.items()}
    out = aggregate.aggregate_flags(out, {v: aggregate.flag_sources(v, names, cfg) for v in tested}, valued, terms, at)
    if terms:
        out = columns(out)
    if grey is not None:
        out = greylist.override(out, grey, predicates)
    return aggregate.override_bad(out, tested, cfg.bad_value_text)


def _resolves(df: DataFrame, cfg: QCConfig) -> bool:
    """Whether all query rules need only columns that are there."""
    try:
        df.select(*[F.expr(r.predicate) for r in cfg.query_rules])
    except AnalysisException:
        return False
    return True

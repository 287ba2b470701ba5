"""Sea-water density as column expressions (TEOS-10), evaluated inside generated code.

Conservative temperature goes over the potential temperature as in the published algorithm; density and
sigma0 use the 75-term polynomial of Roquet et al. (2015). Absolute salinity is the reference-composition
value (35.16504 / 35) * S_P; the regional correction needs an atlas and is not applied.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.functions.flags import without_bad_values

# Published constants and polynomial coefficients {(salinity, temperature, pressure) powers: value}.
SALINITY_FACTOR = 35.16504 / 35
S_SCALE = 0.0248826675584615
S_OFFSET = 0.5971840214030754
CP0 = 3991.86795711963
T0 = 273.15
SSO = 35.16504
# Specific volume in (sqrt(S_SCALE * SA + S_OFFSET), CT / 40, p / 10^4).
_VOLUME = {
    (0, 0, 0): 1.0769995862e-3, (0, 0, 1): -6.0799143809e-5, (0, 0, 2): 9.9856169219e-6,
    (0, 0, 3): -1.1309361437e-6, (0, 0, 4): 1.0531153080e-7, (0, 0, 5): -1.2647261286e-8,
    (0, 0, 6): 1.9613503930e-9, (0, 1, 0): -1.5649734675e-5, (0, 1, 1): 1.8505765429e-5,
    (0, 1, 2): -1.1736386731e-6, (0, 1, 3): -3.6527006553e-7, (0, 1, 4): 3.1454099902e-7,
    (0, 2, 0): 2.7762106484e-5, (0, 2, 1): -1.1716606853e-5, (0, 2, 2): 2.1305028740e-6, (0, 2, 3): 2.8695905159e-7,
    (0, 3, 0): -1.6521159259e-5, (0, 3, 1): 7.9279656173e-6, (0, 3, 2): -4.6132540037e-7,
    (0, 4, 0): 6.9111322702e-6, (0, 4, 1): -3.4102187482e-6, (0, 4, 2): -6.3352916514e-8,
    (0, 5, 0): -8.0539615540e-7, (0, 5, 1): 5.0736766814e-7, (0, 6, 0): 2.0543094268e-7,
    (1, 0, 0): -3.1038981976e-4, (1, 0, 1): 2.4262468747e-5, (1, 0, 2): -5.8484432984e-7,
    (1, 0, 3): 3.6310188515e-7, (1, 0, 4): -1.1147125423e-7, (1, 1, 0): 3.5009599764e-5,
    (1, 1, 1): -9.5677088156e-6, (1, 1, 2): -5.5699154557e-6, (1, 1, 3): -2.7295696237e-7,
    (1, 2, 0): -3.7435842344e-5, (1, 2, 1): -2.3678308361e-7, (1, 2, 2): 3.9137387080e-7,
    (1, 3, 0): 2.4141479483e-5, (1, 3, 1): -3.4558773655e-6, (1, 3, 2): 7.7618888092e-9,
    (1, 4, 0): -8.7595873154e-6, (1, 4, 1): 1.2956717783e-6, (1, 5, 0): -3.3052758900e-7,
    (2, 0, 0): 6.6928067038e-4, (2, 0, 1): -3.4792460974e-5, (2, 0, 2): -4.8122251597e-6,
    (2, 0, 3): 1.6746303780e-8, (2, 1, 0): -4.3592678561e-5, (2, 1, 1): 1.1100834765e-5, (2, 1, 2): 5.4620748834e-6,
    (2, 2, 0): 3.5907822760e-5, (2, 2, 1): 2.9283346295e-6, (2, 2, 2): -6.5731104067e-7,
    (2, 3, 0): -1.4353633048e-5, (2, 3, 1): 3.1655306078e-7, (2, 4, 0): 4.3703680598e-6,
    (3, 0, 0): -8.5047933937e-4, (3, 0, 1): 3.7470777305e-5, (3, 0, 2): 4.9263106998e-6, (3, 1, 0): 3.4532461828e-5,
    (3, 1, 1): -9.8447117844e-6, (3, 1, 2): -1.3544185627e-6, (3, 2, 0): -1.8698584187e-5,
    (3, 2, 1): -4.8826139200e-7, (3, 3, 0): 2.2863324556e-6, (4, 0, 0): 5.8086069943e-4,
    (4, 0, 1): -1.7322218612e-5, (4, 0, 2): -1.7811974727e-6, (4, 1, 0): -1.1959409788e-5,
    (4, 1, 1): 2.5909225260e-6, (4, 2, 0): 3.8595339244e-6, (5, 0, 0): -2.1092370507e-4, (5, 0, 1): 3.0927427253e-6,
    (5, 1, 0): 1.3864594581e-6, (6, 0, 0): 3.1932457305e-5,
}
# Entropy part of the Gibbs function in (sqrt(S_SCALE * SA), t / 40, p / 10^4).
_ENTROPY = {
    (0, 0, 1): -270.983805184062, (0, 0, 2): 776.153611613101, (0, 0, 3): -196.51255088122,
    (0, 0, 4): 28.9796526294175, (0, 0, 5): -2.13290083518327, (0, 1, 0): -24715.571866078,
    (0, 1, 1): 2910.0729080936, (0, 1, 2): -1513.116771538718, (0, 1, 3): 546.959324647056,
    (0, 1, 4): -111.1208127634436, (0, 1, 5): 8.68841343834394, (0, 2, 0): 2210.2236124548363,
    (0, 2, 1): -2017.52334943521, (0, 2, 2): 1498.081172457456, (0, 2, 3): -718.6359919632359,
    (0, 2, 4): 146.4037555781616, (0, 2, 5): -4.9892131862671505, (0, 3, 0): -592.743745734632,
    (0, 3, 1): 1591.873781627888, (0, 3, 2): -1207.261522487504, (0, 3, 3): 608.785486935364,
    (0, 3, 4): -105.4993508931208, (0, 4, 0): 290.12956292128547, (0, 4, 1): -973.091553087975,
    (0, 4, 2): 602.603274510125, (0, 4, 3): -276.361526170076, (0, 4, 4): 32.40953340386105,
    (0, 5, 0): -113.90630790850321, (0, 5, 1): 381.06836198507096, (0, 5, 2): -133.7383902842754,
    (0, 5, 3): 49.023632509086724, (0, 6, 0): 21.35571525415769, (0, 6, 1): -67.41756835751434,
    (2, 0, 1): 729.116529735046, (2, 0, 2): -343.956902961561, (2, 0, 3): 124.687671116248,
    (2, 0, 4): -31.656964386073, (2, 0, 5): 7.04658803315449, (2, 1, 0): 1760.062705994408,
    (2, 1, 1): -1721.528607567954, (2, 1, 2): 674.819060538734, (2, 1, 3): -356.629112415276,
    (2, 1, 4): 88.4080716616, (2, 1, 5): -15.84003094423364, (2, 2, 0): -675.802947790203,
    (2, 2, 1): 2082.7344423998043, (2, 2, 2): -614.668925894709, (2, 2, 3): 340.685093521782,
    (2, 2, 4): -33.3848202979239, (2, 3, 0): 365.7041791005036, (2, 3, 1): -1190.914967948748,
    (2, 3, 2): 298.904564555024, (2, 3, 3): -145.9491676006352, (2, 4, 0): -108.30162043765552,
    (2, 5, 0): 12.78101825083098, (3, 0, 1): -175.292041186547, (3, 0, 2): 83.1923927801819,
    (3, 0, 3): -29.483064349429, (3, 1, 0): -86.1329351956084, (3, 1, 1): 766.116132004952,
    (3, 1, 2): -108.3834525034224, (3, 1, 3): 51.2796974779828, (3, 2, 0): -30.0682112585625,
    (3, 2, 1): -1380.9597954037708, (3, 3, 0): 3.50240264723578, (3, 3, 1): 938.26075044542,
    (4, 0, 1): -22.6683558512829, (4, 1, 0): -137.1145018408982, (4, 2, 0): 148.10030845687618,
    (4, 3, 0): -68.5590309679152, (4, 4, 0): 12.4848504784754,
}
# Potential enthalpy in (sqrt(S_SCALE * SA), potential temperature / 40, -).
_ENTHALPY = {
    (0, 0, 0): 61.01362420681071, (0, 1, 0): 168776.46138048015, (0, 2, 0): -2735.2785605119625,
    (0, 3, 0): 2574.2164453821433, (0, 4, 0): -1536.6644434977543, (0, 5, 0): 545.7340497931629,
    (0, 6, 0): -50.91091728474331, (0, 7, 0): -18.30489878927802, (2, 0, 0): 268.5520265845071,
    (2, 1, 0): -12019.028203559312, (2, 2, 0): 3734.858026725145, (2, 3, 0): -2046.7671145057618,
    (2, 4, 0): 465.28655623826234, (2, 5, 0): -0.6370820302376359, (2, 6, 0): -10.650848542359153,
    (3, 0, 0): 937.2099110620707, (3, 1, 0): 588.1802812170108, (3, 2, 0): 248.39476522971285,
    (3, 3, 0): -3.871557904936333, (3, 4, 0): -2.6268019854268356, (4, 0, 0): -1687.914374187449,
    (4, 1, 0): 936.3206544460336, (4, 2, 0): -942.7827304544439, (4, 3, 0): 369.4389437509002,
    (4, 4, 0): -33.83664947895248, (4, 5, 0): -9.987880382780322, (5, 0, 0): 246.9598888781377,
    (6, 0, 0): 123.59576582457964, (7, 0, 0): -48.5891069025409,
}
# First guess of the potential temperature: t + p * polynomial in (35 / 35.16504 * SA, t, p).
_FIRST_GUESS = {
    (0, 0, 0): 8.65483913395442e-6, (1, 0, 0): -1.41636299744881e-6, (0, 0, 1): -7.38286467135737e-9,
    (0, 1, 0): -8.38241357039698e-6, (1, 1, 0): 2.83933368585534e-8, (0, 2, 0): 1.77803965218656e-8,
    (0, 1, 1): 1.71155619208233e-10,
}

Coefficients = Mapping[tuple[int, int, int], float]


def _horner(by_power: Mapping[int, Column], x: Column) -> Column:
    top = max(by_power)
    out = by_power[top]
    for n in range(top - 1, -1, -1):
        out = out * x
        if n in by_power:
            out = out + by_power[n]
    return out


def polynomial(coefficients: Coefficients, x: Column, y: Column, z: Column | None) -> Column:
    """Sum of c * x^i * y^j * z^k in nested form; without z only the k = 0 terms."""
    nested: dict[int, dict[int, dict[int, Column]]] = defaultdict(lambda: defaultdict(dict))
    for (i, j, k), c in coefficients.items():
        if z is not None or k == 0:
            nested[i][j][k] = F.lit(float(c))
    return _horner(
        {i: _horner({j: _horner(ks, z) if z is not None else ks[0] for j, ks in js.items()}, y) for i, js in nested.items()},
        x,
    )


def _slope(coefficients: Coefficients) -> dict[tuple[int, int, int], float]:
    """Derivative with respect to the second variable."""
    return {(i, j - 1, k): j * float(c) for (i, j, k), c in coefficients.items() if j > 0}


def density_from(sa: Column, ct: Column, p: Column) -> Column:
    x = F.sqrt(F.greatest(sa, F.lit(0.0)) * S_SCALE + S_OFFSET)
    return 1 / polynomial(_VOLUME, x, ct * 0.025, p * 1e-4)


def _with_conservative_temperature(df: DataFrame, sa: str, t: str, p: str, out: str) -> DataFrame:
    """Two corrected Newton steps to the potential temperature, then its potential enthalpy.

    Each step is a projection of its own, so no sub-expression is evaluated twice.
    """
    S, T, P = F.col(sa), F.col(t), F.col(p)
    x, true = F.col("qc_x"), F.col("qc_true")
    guess = T + P * polynomial(_FIRST_GUESS, S / SALINITY_FACTOR, T, P)
    df = df.withColumn("qc_x", F.sqrt(F.greatest(S, F.lit(0.0)) * S_SCALE)).withColumns(
        {"qc_true": polynomial(_ENTROPY, x, T * 0.025, P * 1e-4) * -0.025, "qc_pt": guess})
    df = df.withColumn("qc_rate", CP0 / ((T0 + F.col("qc_pt")) * (1 - 0.05 * (1 - S / SSO))))
    for _ in range(2):
        miss = polynomial(_ENTROPY, x, F.col("qc_pt") * 0.025, None) * -0.025 - true
        df = df.withColumn("qc_miss", miss)
        middle = F.col("qc_pt") - F.col("qc_miss") / F.col("qc_rate") / 2
        df = df.withColumn("qc_mid", middle)
        rate = polynomial(_slope(_ENTROPY), x, F.col("qc_mid") * 0.025, None) * -0.000625
        df = df.withColumn("qc_rate", rate).withColumn("qc_pt", F.col("qc_pt") - F.col("qc_miss") / F.col("qc_rate"))
    df = df.withColumn(out, polynomial(_ENTHALPY, x, F.col("qc_pt") * 0.025, None) / CP0)
    return df.drop("qc_x", "qc_true", "qc_pt", "qc_rate", "qc_miss", "qc_mid")


def derive_density(df: DataFrame) -> DataFrame:
    """Add ``absolute salinity``, ``conservative temperature``, ``density`` and ``sigma0``.

    Vendor-marked values count as missing; any missing input gives NULL.
    """
    sp, t, p = (without_bad_values(F.col(c)) for c in ("salinity", "temperature", "pressure"))
    sa = sp * SALINITY_FACTOR
    out = df.withColumns({"absolute salinity": F.when(p.isNotNull(), sa), "qc_t": t, "qc_p": p})
    out = _with_conservative_temperature(out, "absolute salinity", "qc_t", "qc_p", "conservative temperature")
    SA, CT = F.col("absolute salinity"), F.col("conservative temperature")
    return out.withColumns(
        {"density": density_from(SA, CT, F.col("qc_p")), "sigma0": density_from(SA, CT, F.lit(0.0)) - 1000}
    ).drop("qc_t", "qc_p")

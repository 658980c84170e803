"""Numeric column helpers shared by every operator.

All helpers return Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def np_round(c: Column | str, ndigits: int) -> Column:
    """NumPy/pandas rounding: ``rint(x * 10**n) / 10**n`` (half-even on the
    scaled double).  Spark's ``round`` (half-up) and ``bround`` (decimal
    half-even) disagree with it on values such as 1.015 and 2.345."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** ndigits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def nan_to_null(c: Column | str) -> Column:
    """Treat NaN as missing, as pandas does (Spark orders NaN above every number
    and counts it as a value)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def normalize_nans(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating-point column."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(nan_to_null(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def pairwise(x: Column | str, y: Column | str) -> tuple[Column, Column]:
    """Both columns nulled where either is null (pairwise-complete rows)."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x), F.when(both, y)


def pearson(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over pairwise-complete rows, NULL for a constant or
    too-short input.  ``F.corr`` raises DIVIDE_BY_ZERO on a constant column
    under ANSI mode, so the ratio is formed with ``try_divide``."""
    xs, ys = pairwise(x, y)
    return F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys))


# Rational approximations of the normal quantile (Applied
# Statistics algorithm AS 241, 1988, about 1e-16): numerator and denominator
# coefficients for the centre, the near tail and the far tail.
_CENTRE = ([3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
            45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727],
           [1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
            21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610])
_NEAR = ([1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
          1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4],
         [1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
          0.148103976427480074590, 0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9])
_FAR = ([6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
         0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7],
        [1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
         7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15])


def _ratio(parts, x: Column) -> Column:
    def poly(c):
        out = F.lit(0.0)
        for v in reversed(c):
            out = out * x + F.lit(v)
        return out
    return poly(parts[0]) / poly(parts[1])


def norm_ppf_col(p: Column) -> Column:
    """Normal quantile of a probability strictly between 0 and 1."""
    q = p - 0.5
    centre = q * _ratio(_CENTRE, 0.180625 - q * q)
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.when(r <= 5, _ratio(_NEAR, r - 1.6)).otherwise(_ratio(_FAR, r - 5.0))
    return F.when(F.abs(q) <= 0.425, centre).otherwise(F.signum(q) * tail)


# Rational approximations of the error function (W. J. Cody,
# Mathematics of Computation 23, 1969, about 1e-16), constant term first: erf near
# zero, erfc in the middle, erfc in the tail; numerator and denominator each.
_ERF_NEAR = ([3209.37758913846947, 377.485237685302021, 113.864154151050156, 3.16112374387056560, 0.185777706184603153],
             [2844.23683343917062, 1282.61652607737228, 244.024637934444173, 23.6012909523441209, 1.0])
_ERFC_MIDDLE = ([1230.33935479799725, 2051.07837782607147, 1712.04761263407058, 881.952221241769090, 298.635138197400131,
                 66.1191906371416295, 8.88314979438837594, 0.564188496988670089, 2.15311535474403846e-8],
                [1230.33935480374942, 3439.36767414372164, 4362.61909014324716, 3290.79923573345963, 1621.38957456669019,
                 537.181101862009858, 117.693950891312499, 15.7449261107098347, 1.0])
_ERFC_TAIL = ([6.58749161529837803e-4, 0.0160837851487422766, 0.125781726111229246, 0.360344899949804439, 0.305326634961232344, 0.0163153871373020978],
              [0.00233520497626869185, 0.0605183413124413191, 0.527905102951428412, 1.87295284992346725, 2.56852019228982242, 1.0])
_ROOT_PI = 1.7724538509055160


def _log_erfc(y: Column) -> Column:
    """Logarithm of erfc(y) for y >= 0; no underflow."""
    yy = y * y
    near = F.log1p(-y * _ratio(_ERF_NEAR, yy))
    middle = -yy + F.log(_ratio(_ERFC_MIDDLE, y))
    inverse = F.lit(1.0) / F.greatest(yy, F.lit(1.0))
    tail = -yy + F.log((1.0 / _ROOT_PI - inverse * _ratio(_ERFC_TAIL, inverse)) / F.greatest(y, F.lit(1.0)))
    return F.when(y <= 0.46875, near).when(y <= 4, middle).otherwise(tail)


def norm_log_cdf_col(z: Column) -> Column:
    """Logarithm of the normal distribution function, exact far into both tails."""
    half = _log_erfc(F.abs(z) / F.lit(2.0 ** 0.5)) - F.lit(0.6931471805599453)
    return F.when(z <= 0, half).otherwise(F.log1p(-F.exp(half)))

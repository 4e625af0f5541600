"""Tail probabilities as closed series, evaluated by Spark's `aggregate`.

Abramowitz & Stegun, Handbook of Mathematical Functions, 26.7.3-4 (Student's t,
whole degrees of freedom) and 26.2.11 (normal). In the tails, where one minus the
inner part would cancel, 6.6.8 with 26.5.4 (incomplete beta) and 26.2.14 (continued fraction).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ranklab.functions.text import let

_STATE = "struct<term:double,total:double>"
# Terms of the normal series up to |z| = 3; steps of the continued fraction beyond.
_NORMAL_TERMS = 60
_FRACTION_STEPS = 80
# Terms of the beta series, whose ratio is below df / (df + t^2) <= 1/2 in the tail.
_BETA_TERMS = 60


def _series(first: Column, n_more: Column, factor) -> Column:
    """first + first*factor(1) + first*factor(1)*factor(2) + ... with n_more further terms."""
    start = F.struct(first.cast("double").alias("term"), first.cast("double").alias("total"))
    steps = F.when(n_more > 0, F.sequence(F.lit(1), F.greatest(n_more, F.lit(1)).cast("int"))) \
        .otherwise(F.array().cast("array<int>"))

    def step(state: Column, i: Column) -> Column:
        term = state.getField("term") * factor(i)
        return F.struct(term.alias("term"), (state.getField("total") + term).alias("total"))

    return F.aggregate(steps, start.cast(_STATE), step, lambda state: state.getField("total"))


def t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) for Student's t with a whole number of degrees of freedom."""
    def inside(theta: Column) -> Column:
        cos2 = F.cos(theta) * F.cos(theta)
        even = F.sin(theta) * _series(
            F.lit(1.0), (df / 2).cast("int") - 1,
            lambda i: cos2 * (2 * i - 1) / (2 * i))
        odd_tail = F.sin(theta) * F.cos(theta) * _series(
            F.lit(1.0), ((df - 3) / 2).cast("int"),
            lambda i: cos2 * (2 * i) / (2 * i + 1))
        odd = (theta + F.when(df > 1, odd_tail).otherwise(0.0)) * (2.0 / 3.141592653589793)
        return F.when(df % 2 == 0, even).otherwise(odd)

    def tail(x: Column) -> Column:
        # x^a g(a) sum of (1/2)_n / n! * a / (a + n) * x^n with a = df / 2; g(a) by products of steps of 1
        a, half = df / 2, (df / 2).cast("int")
        odd = df % 2 == 1
        shift = F.when(odd, 0.5).otherwise(0.0)
        g = F.aggregate(F.when(half > 0, F.sequence(F.lit(1), F.greatest(half, F.lit(1)))).otherwise(F.array().cast("array<int>")),
                        F.when(odd, 2.0 / 3.141592653589793).otherwise(1.0),
                        lambda p, i: p * (i - 0.5 + shift) / (i + shift))
        return F.pow(x, a) * g * _series(F.lit(1.0), F.lit(_BETA_TERMS),
                                         lambda n: (n - 0.5) / n * x * (a + n - 1) / (a + n))

    d = df.cast("double")
    near = F.greatest(F.lit(1.0) - let(F.atan(F.abs(t) / F.sqrt(d)), inside), F.lit(0.0))
    return F.when(t.isNotNull(), F.when(t * t > d, let(d / (d + t * t), tail)).otherwise(near))


def normal_two_sided(z: Column) -> Column:
    """P(|Z| >= |z|) for the standard normal."""
    def tail(a: Column) -> Column:
        density = F.exp(-a * a / 2) / 2.5066282746310002
        total = _series(a, F.lit(_NORMAL_TERMS), lambda i: a * a / (2 * i + 1))
        fraction = F.aggregate(F.sequence(F.lit(_FRACTION_STEPS), F.lit(1), F.lit(-1)), a, lambda f, i: a + i / f)
        return F.when(a > 3, 2.0 * density / fraction).otherwise(1.0 - 2.0 * density * total)

    return let(F.abs(z), tail)

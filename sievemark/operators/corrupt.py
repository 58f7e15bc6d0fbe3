"""Seeded damage to tables, for training and for testing the checks.

Every choice hangs on a hash of the row key, the seed and the column, so a run gives the
same table again however it is partitioned, and a lost task redoes exactly its rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.columns import col, column_classes
from sievemark.functions.hashing import uniform, uniform_from
from sievemark.operators.quantiles import exact_quantiles
from sievemark.session import materialize

# Tokens that spoil numeric cells.
BAD_TOKENS = ("N/A", "NULL", "###", "???", "ERROR", "MISSING")


def poisson_steps(mean: float) -> list[float]:
    """The distribution function of a Poisson number, as far as a double tells it from one."""
    steps, term, total, k = [], math.exp(-mean), 0.0, 0
    while (total := total + term) < 1 - 2**-52 and (not steps or total > steps[-1]):
        steps.append(total)
        k += 1
        term *= mean / k
    return steps


@dataclass(frozen=True)
class Dice:
    """Where randomness comes from: key columns, seed and hash."""

    key: tuple[str, ...]
    seed: int = 42
    algorithm: str = "xxhash64"

    def roll(self, tag: str) -> Column:
        return uniform([col(k) for k in self.key], self.seed, tag, self.algorithm)

    def spares(self, tag: str, rate: float) -> Column:
        """Whether the roll is ``rate`` or more."""
        return uniform_from([col(k) for k in self.key], self.seed, tag, rate, self.algorithm)

    def normal(self, tag: str, within: Sequence[str] = ()) -> Column:
        """A standard normal number per key (and the columns of ``within``), by Box-Muller on two hashed numbers."""
        key = [col(k) for k in (*self.key, *within)]
        one, two = (uniform(key, self.seed, f"n{i}:{tag}", self.algorithm) for i in (1, 2))
        return F.sqrt(-2 * F.ln(1 - one)) * F.cos(2 * F.pi() * two)  # 1 - u keeps the logarithm finite

    def poisson(self, tag: str, mean: float) -> Column:
        """A Poisson number per key: how many of the distribution's steps its hashed number has passed."""
        u = self.roll(tag)
        return sum((F.when(u >= F.lit(step), 1).otherwise(0) for step in poisson_steps(mean)), F.lit(0))

    def flip(self, tag: str) -> float:
        """One number per tag for choices about whole columns, made on the driver."""
        import hashlib

        return int(hashlib.md5(f"{self.seed}|{tag}".encode()).hexdigest()[:13], 16) / 2**52


def _data(df: DataFrame, dice: Dice, columns: Sequence[str] | None, numeric: bool) -> list[str]:
    if columns is not None:
        return list(columns)
    pool = column_classes(df).numeric if numeric else df.columns
    return [c for c in pool if c not in dice.key]


def inject_nulls(df: DataFrame, dice: Dice, rate: float, columns: Sequence[str] | None = None) -> DataFrame:
    """Each cell becomes null with the given rate."""
    return df.withColumns({
        c: F.when(dice.spares(f"null:{c}", rate), col(c)) for c in _data(df, dice, columns, False)
    })


def inject_duplicates(df: DataFrame, dice: Dice, fraction: float) -> DataFrame:
    """Append a seeded fraction of the rows once more."""
    return df.unionByName(df.filter(dice.roll("duplicate") < fraction))


def inject_duplicates_replaced(df: DataFrame, dice: Dice, fraction: float) -> DataFrame:
    """Append rows drawn with replacement: each row a Poisson number of times, fixed by its key."""
    return df.unionByName(_drawn(df, dice, fraction).drop(_COPY))


_COPY = "_copy"


def _drawn(df: DataFrame, dice: Dice, mean: float) -> DataFrame:
    """Each row a Poisson number of times, the times numbered from 1."""
    times = dice.poisson("draws", mean)
    return df.withColumn(_COPY, times).filter(F.col(_COPY) > 0).withColumn(_COPY, F.explode(F.sequence(F.lit(1), F.col(_COPY))))


def scramble_types(df: DataFrame, dice: Dice, columns: Sequence[str] | None = None, share: float = 0.5) -> DataFrame:
    """A random part of the numeric columns turns into text."""
    chosen = [c for c in _data(df, dice, columns, True) if dice.flip(f"scramble:{c}") < share]
    return df.withColumns({c: col(c).cast("string") for c in chosen})


def inject_outliers_median(
    df: DataFrame, dice: Dice, rate: float, multiplier: float,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Cells jump to plus or minus the median times a multiplier."""
    names = _data(df, dice, columns, True)
    medians = exact_quantiles(df, names, [0.5])
    spoiled = {}
    for c in names:
        sign = 1.0 if dice.flip(f"sign:{c}") > 0.5 else -1.0
        target = (medians[c, 0.5] or 1.0) * multiplier * sign
        spoiled[c] = F.when(dice.roll(f"outlier:{c}") < rate, F.lit(target)).otherwise(col(c).cast("double"))
    return df.withColumns(spoiled)


def inject_outliers_max(df: DataFrame, dice: Dice, rate: float, columns: Sequence[str] | None = None) -> DataFrame:
    """Cells jump to somewhere between two and five times the column maximum."""
    names = _data(df, dice, columns, True)
    top = df.agg(*[F.max(col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(names)]).first()
    return df.withColumns({
        c: F.when(
            dice.roll(f"outlier:{c}") < rate, (2 + 3 * dice.roll(f"size:{c}")) * F.lit(top[f"m{i}"])
        ).otherwise(col(c).cast("double"))
        for i, c in enumerate(names)
    })


def inject_outliers_const(
    df: DataFrame, dice: Dice, rate: float = 0.12, value: float = 999_999.0, first: int = 3
) -> DataFrame:
    """The first numeric columns get plus or minus one huge value."""
    names = _data(df, dice, None, True)[:first]
    return df.withColumns({
        c: F.when(
            dice.roll(f"outlier:{c}") < rate,
            F.when(dice.roll(f"side:{c}") < 0.5, F.lit(value)).otherwise(F.lit(-value)),
        ).otherwise(col(c).cast("double"))
        for c in names
    })


def inject_text(
    df: DataFrame, dice: Dice, rate: float, columns: Sequence[str], tokens: Sequence[str] = BAD_TOKENS
) -> DataFrame:
    """Non-null numeric cells turn into one of the tokens; the columns become text."""
    words = F.array(*[F.lit(t) for t in tokens])
    out = {}
    for c in columns:
        pick = F.element_at(words, (F.floor(dice.roll(f"token:{c}") * len(tokens)) + 1).cast("int"))
        hit = col(c).isNotNull() & (dice.roll(f"text:{c}") < rate)
        out[c] = F.when(hit, pick).otherwise(col(c).cast("string"))
    return df.withColumns(out)


def inject_noise(df: DataFrame, dice: Dice, rate: float, columns: Sequence[str] | None = None) -> DataFrame:
    """Gaussian noise of the column's own deviation on a share of the rows."""
    names = _data(df, dice, columns, True)
    sd = df.agg(*[F.stddev_samp(col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(names)]).first()
    out = {}
    for i, c in enumerate(names):
        x = col(c).cast("double")
        out[c] = F.when(dice.roll(f"noise:{c}") < rate, x + dice.normal(c) * F.lit(sd[f"s{i}"] or 0.0)).otherwise(x)
    return df.withColumns(out)


def inject_suffix(df: DataFrame, dice: Dice, column: str, rate: float = 0.04, suffix: str = "X") -> DataFrame:
    """A suffix that breaks the format, such as 1998X."""
    text = col(column).cast("string")
    return df.withColumn(column, F.when(dice.roll(f"suffix:{column}") < rate, F.concat(text, F.lit(suffix))).otherwise(text))


def inject_code(df: DataFrame, dice: Dice, column: str, rate: float = 0.06, code: str = "XXX") -> DataFrame:
    """A code that does not exist."""
    return df.withColumn(column, F.when(dice.roll(f"code:{column}") < rate, F.lit(code)).otherwise(col(column)))


def drop_rows(df: DataFrame, dice: Dice, fraction: float) -> DataFrame:
    return df.filter(dice.roll("drop") >= fraction)


def scramble_names(df: DataFrame, dice: Dice) -> DataFrame:
    """Column names in random case, some with a space for an underscore."""
    out = []
    for c in df.columns:
        u = dice.flip(f"name:{c}")
        name = c.upper() if u < 1 / 3 else c.title() if u < 2 / 3 else c
        out.append(name.replace("_", " ") if dice.flip(f"space:{c}") < 0.5 else name)
    return df.toDF(*out)


@dataclass(frozen=True)
class CorruptionProfile:
    """Chance of each damage and its range."""

    apply_probability: float = 0.7
    type_probability: float = 0.4
    null_rate: tuple[float, float] = (0.02, 0.15)
    duplicate_fraction: tuple[float, float] = (0.05, 0.25)
    outlier_rate: tuple[float, float] = (0.01, 0.08)
    outlier_multiplier: tuple[float, float] = (5.0, 20.0)


def corrupt_mix(
    df: DataFrame, dice: Dice, profile: CorruptionProfile = CorruptionProfile()
) -> DataFrame:
    """Each kind of damage is applied or not by chance, as one chained expression."""
    between = lambda tag, span: span[0] + dice.flip(tag) * (span[1] - span[0])
    if dice.flip("apply:nulls") < profile.apply_probability:
        df = inject_nulls(df, dice, between("rate:nulls", profile.null_rate))
    if dice.flip("apply:duplicates") < profile.apply_probability:
        df = inject_duplicates(df, dice, between("rate:duplicates", profile.duplicate_fraction))
    if dice.flip("apply:types") < profile.type_probability:
        df = scramble_types(df, dice)
    if dice.flip("apply:outliers") < profile.apply_probability:
        df = inject_outliers_median(
            df, dice, between("rate:outliers", profile.outlier_rate),
            between("size:outliers", profile.outlier_multiplier),
        )
    return df


def corrupt_combined(df: DataFrame, dice: Dice, nulls: float = 0.15, duplicates: float = 0.1) -> DataFrame:
    return inject_duplicates(inject_nulls(df, dice, nulls), dice, duplicates)


def corrupt_level(df: DataFrame, dice: Dice, level: float, numeric: Sequence[str] | None = None) -> DataFrame:
    """All damages scaled by one level from 0 to 1."""
    out = inject_nulls(df, dice, 0.3 * level)
    out = inject_noise(out, dice, 0.2 * level, numeric)
    return inject_duplicates(out, dice, 0.2 * level)


def bootstrap(df: DataFrame, dice: Dice, share: float = 0.05) -> DataFrame:
    """Rows with replacement, numeric columns blurred by a share of their deviation."""
    names = _data(df, dice, None, True)
    sd = df.agg(*[F.stddev_samp(col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(names)]).first()
    return _drawn(df, dice, 1.0).withColumns({
        c: col(c).cast("double") + dice.normal(f"blur:{c}", [_COPY]) * F.lit(share * (sd[f"s{i}"] or 0.0))
        for i, c in enumerate(names)
    }).drop(_COPY)


def interpolate(df: DataFrame, dice: Dice) -> DataFrame:
    """Rows mixed in pairs: numbers convexly, other columns from either row.

    Partners are the same rows in another seeded order, matched by row number.
    """
    from sievemark.operators.order import with_row_id

    numeric = set(_data(df, dice, None, True))
    left = with_row_id(df.withColumn("_o", dice.roll("left")), ["_o", *dice.key])
    right = with_row_id(df.withColumn("_o", dice.roll("right")), ["_o", *dice.key])
    pairs = left.alias("a").join(right.alias("b"), F.col("a._row_id") == F.col("b._row_id"))
    mix = F.col("a._o")  # already uniform in [0, 1)
    side = lambda s, c: F.col(f"{s}.`{c}`")
    return pairs.select(*[
        (mix * side("a", c) + (1 - mix) * side("b", c)).alias(c) if c in numeric
        else side("a", c).alias(c) if c in dice.key
        else F.when(mix < 0.5, side("a", c)).otherwise(side("b", c)).alias(c)
        for c in df.columns
    ])


def labelled_pairs(
    df: DataFrame, dice: Dice, features, damage: Callable[[DataFrame, Dice], DataFrame] = corrupt_mix, **options
) -> DataFrame:
    """Features of the table labelled 1 and of its damaged copy labelled 0.

    The copy is written once: features take several scans, and each would roll the dice of all its columns again.
    """
    good = features(df, **options).withColumn("label", F.lit(1))
    bad = features(materialize(damage(df, dice), "twin"), **options).withColumn("label", F.lit(0))
    return good.unionByName(bad)

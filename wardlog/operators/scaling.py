"""Exact medians and population scaling, as expressions that also fit into an ML pipeline."""

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlog import schema as S

ACCURACY = 10_000
KEPT = 5_000  # values of one bracket that are sorted in one place


def numeric_features(columns) -> list[str]:
    """The list without identifiers."""
    return [c for c in columns if c not in S.IDENTIFIERS]


def exact_values(df: DataFrame, wanted: list[tuple[str, int]], counts: dict) -> dict:
    """{(column, rank): value}: the value at a rank from 1 among a column's non-NULL values.

    Each wanted value has a bracket, open at both ends. A round reads the rows once for quantiles of the values inside
    the brackets, which narrow them (the sketch's rank error is below 1 / ACCURACY of what is inside), and once to count what
    lies below and at the new ends. A bracket keeps a thousandth of its rows or less, so a few rounds lead to KEPT rows,
    which are then sorted. A value that stands in any number of rows ends the search as soon as it is an end.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in {c for c, _ in wanted}])
    found = {}
    brackets = {w: (None, None, 0, counts[w[0]]) for w in wanted}  # ends, rows up to the lower one, rows inside

    def inside(c, low, high):
        value = F.col(c)
        held = value.isNotNull()
        return held & (value > F.lit(low) if low is not None else F.lit(True)) & (value < F.lit(high) if high is not None else F.lit(True))

    while any(b[3] > KEPT for b in brackets.values()):
        large = {w: b for w, b in brackets.items() if b[3] > KEPT}

        def near(w, low, high, below, rows):
            share = (w[1] - below) / rows
            ends = [max(0.0, share - 2 / ACCURACY), min(1.0, share + 2 / ACCURACY)]
            return F.percentile_approx(F.when(inside(w[0], low, high), F.col(w[0])), ends, ACCURACY)

        ends = doubles.agg(*[near(w, *b).alias(f"q{i}") for i, (w, b) in enumerate(large.items())]).first()

        def counted(i, c, name, condition):
            return F.count_if(condition).alias(f"{name}{i}")

        tallies = doubles.agg(*[
            counted(i, w[0], name, condition) for i, w in enumerate(large) for low, high in [ends[f"q{i}"]]
            for name, condition in (("a", F.col(w[0]) < F.lit(low)), ("b", F.col(w[0]) <= F.lit(low)),
                                    ("c", F.col(w[0]) < F.lit(high)), ("d", F.col(w[0]) <= F.lit(high)))
        ]).first()
        for i, (w, (low, high, below, _)) in enumerate(large.items()):
            new_low, new_high = ends[f"q{i}"]
            under, upto, before_high, upto_high = (tallies[f"{n}{i}"] for n in "abcd")
            if under < w[1] <= upto or before_high < w[1] <= upto_high:
                found[w] = new_low if w[1] <= upto and under < w[1] else new_high
                del brackets[w]
            elif upto < w[1] <= before_high:
                brackets[w] = (new_low, new_high, upto, before_high - upto)
            elif w[1] <= under:  # outside the sketch's error; the other side is as good an end
                brackets[w] = (low, new_low, below, under - below)
            else:
                brackets[w] = (new_high, high, upto_high, below + brackets[w][3] - upto_high)
    if brackets:
        row = doubles.agg(*[
            F.element_at(F.sort_array(F.collect_list(F.when(inside(w[0], low, high), F.col(w[0])))), w[1] - below).alias(f"v{i}")
            for i, (w, (low, high, below, _)) in enumerate(brackets.items())
        ]).first()
        found |= {w: row[f"v{i}"] for i, w in enumerate(brackets)}
    return found


def exact_medians(df: DataFrame, columns) -> DataFrame:
    """(feature, median): the middle value, or the mean of the two middle values. Columns without values have no row."""
    counts = df.agg(*[F.count(F.col(c).cast("double")).alias(c) for c in columns]).first().asDict()
    middle = {c: ((n + 1) // 2, n // 2 + 1) for c, n in counts.items() if n}
    found = exact_values(df, sorted({(c, rank) for c, ranks in middle.items() for rank in ranks}), counts)
    rows = [(c, (found[c, a] + found[c, b]) / 2) for c, (a, b) in middle.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, median double")


def impute(df: DataFrame, medians: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in medians.items()})


def moments(df: DataFrame, columns) -> DataFrame:
    """(feature, mean, std) with the population standard deviation; one pass."""
    row = df.agg(*[
        F.struct(F.avg(F.col(c).cast("double")).alias("mean"), F.stddev_pop(F.col(c).cast("double")).alias("std")).alias(c)
        for c in columns
    ])
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c)["mean"].alias("mean"), F.col(c)["std"].alias("std")) for c in columns]
    return row.select(F.explode(F.array(*entries)).alias("m")).select("m.*")


def collect_moments(df: DataFrame, columns) -> dict:
    """{feature: (mean, std)}: two numbers per feature."""
    return {r["feature"]: (r["mean"] or 0.0, r["std"] or 0.0) for r in moments(df, columns).collect()}


def scaled(column, mean, std):
    """(x - mean) / std; a constant column becomes 0."""
    return (F.col(column).cast("double") - F.lit(float(mean))) / F.lit(float(std)) if std else F.lit(0.0)


def standard_scale(df: DataFrame, columns, fitted=None) -> DataFrame:
    fitted = fitted or collect_moments(df, columns)
    return df.withColumns({c: scaled(c, *fitted[c]) for c in columns})


def _number(value) -> str:
    return f"{float(value)!r}D"


def prepare_stage(columns, medians=None, fitted=None, prefix="x_") -> SQLTransformer:
    """A pipeline stage: x_<name> = scaled, filled number. It is stored with the model."""
    parts = []
    for c in columns:
        fill = _number((medians or {}).get(c, 0.0))
        value = f"coalesce(try_cast(`{c}` AS DOUBLE), {fill})"
        if fitted is not None:
            mean, std = fitted[c]
            value = f"({value} - {_number(mean)}) / {_number(std)}" if std else "0.0D"
        parts.append(f"{value} AS `{prefix}{c}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")

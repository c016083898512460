"""Quality rules: a threshold table compiled into one projection.

Every rule is a ratio of two counts with a lowest and a highest value in thousandths, tested in whole
numbers. A document is rejected if it is too short, repeats itself, or breaks a rule of the table.

Defined results: NULL and blank text has no words and fails the length test; a column of the frame that has
the name of the output column is replaced; repeated rows and rows without an id are judged like all others;
an empty frame gives an empty frame. Texts are used whole. Memory is a few arrays of one document's words.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlog.llm.words import SPACE, WORD, bind, table, words_of

# The most frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from he in is it of on or she that the this to was which with you "
    "als auf das dem den der des die ein eine er es für im ist mit nicht sich sie und von zu "
    "au ce dans de du elle en est et il la le les ne par pas pour que qui sur un une "
    "al como con del el ella las los más no para por se su una y"
).split()

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Rule:
    """Holds where low <= 1000 * part / whole <= high, or where the text has under min_words words."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    min_words: int = 0

    def holds(self, count) -> Column:
        part, whole = count(self.part) * 1000, count(self.whole)
        tests = []
        if self.low is not None:
            tests.append(part >= whole * self.low)
        if self.high is not None:
            tests.append(part <= whole * self.high)
        held = tests[0] if len(tests) == 1 else tests[0] & tests[1]
        return held | (count("n_words") < self.min_words) if self.min_words else held

    def sql(self) -> str:
        tests = []
        if self.low is not None:
            tests.append(f"1000 * {self.part} >= {self.low} * {self.whole}")
        if self.high is not None:
            tests.append(f"1000 * {self.part} <= {self.high} * {self.whole}")
        held = " AND ".join(tests)
        return f"(n_words < {self.min_words} OR ({held}))" if self.min_words else f"({held})"


RULES = (
    Rule("word_length", "word_chars", "n_words", low=2000, high=12000),
    Rule("symbols", "n_symbols", "n_words", high=100),
    Rule("stop_words", "n_stop_words", "n_words", low=20, min_words=50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=500),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")


def _repeated(words: Column, size: Column) -> Column:
    """Words that stand in a window found twice or more.

    Windows are compared by a 64-bit hash. Texts without a repeated window, nearly all, stop at the count of
    different hashes; others sort (hash, position) and merge the positions of equal neighbours.
    """
    last = WINDOW - 1

    def hashed(i):
        return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])

    def covered(ordered):
        def again(x, i):
            before, after = F.get(ordered, i - 1)["h"], F.get(ordered, i + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        places = F.sort_array(F.transform(F.filter(ordered, again), lambda x: x["i"]))
        return bind(places, lambda p: F.aggregate(
            F.zip_with(F.slice(p, 2, F.size(p)), F.slice(p, 1, F.size(p) - 1), lambda b, a: F.least(b - a, F.lit(WINDOW))),
            F.lit(WINDOW).cast("long"), lambda total, step: total + step,
        ))

    def counted(hashes):
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            bind(F.sort_array(pairs), covered))

    return F.when(size > last, bind(F.transform(F.sequence(F.lit(0), size - WINDOW), hashed), counted)).otherwise(
        F.lit(0).cast("long"))


def quality_counts(text: Column, stop_words=STOP_WORDS) -> Column:
    """All counts of a text as one struct."""
    text = F.coalesce(text, F.lit(""))
    stop = [F.lit(w) for w in stop_words]

    def of_words(words):
        size = F.size(words)
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))

        def of_lines(found):
            return F.struct(F.size(found).alias("all"), (F.size(found) - F.size(F.array_distinct(found))).alias("dup"))

        return bind(bind(lines, of_lines), lambda found: F.struct(
            size.cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            found["dup"].cast("long").alias("n_dup_lines"),
            _repeated(words, size).alias("n_repeat_words"),
            found["all"].cast("long").alias("n_lines"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(stop))).cast("long").alias("n_stop_words"),
        ))

    return bind(words_of(text), of_words)


def quality_rules(df: DataFrame, text="text", out="quality", rules=RULES) -> DataFrame:
    """Adds a struct: all counts, base_failed, broken (names of the broken rules), kept."""
    counted = df.withColumn(out, quality_counts(F.col(f"`{text}`")))

    def count(name):
        return F.col(f"`{out}`")[name]

    base = (count("n_words") < MIN_WORDS) | (
        count("n_repeat_words") * 100 > count("n_words") * MAX_REPEAT_PERCENT)
    broken = F.filter(
        F.array(*[F.when(~rule.holds(count), F.lit(rule.name)) for rule in rules]), lambda x: x.isNotNull())
    holds = [rule.holds(count) for rule in rules]
    kept = ~base
    for held in holds:
        kept = kept & held
    return counted.withColumn(out, F.struct(
        *[count(n).alias(n) for n in COUNTS], base.alias("base_failed"), broken.alias("broken"), kept.alias("kept")))


def op9_quality_rules(spark, sf_dir):
    judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[
        F.col("quality")[n].alias(n) for n in (*COUNTS, "base_failed", "kept")])


SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
parts AS (
    SELECT doc_id, t, row_number() OVER () AS r,
        list_filter(regexp_split_to_array(t, '{SPACE}'), lambda x: x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
    FROM texts
),
windows AS (
    SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w
    FROM (SELECT r, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS i FROM parts)
),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
covered AS (
    SELECT r, sum(least({WINDOW}, coalesce(following - i, {WINDOW}))) AS n
    FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following FROM again) GROUP BY r
),
counts AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(list_filter(words, lambda x: list_contains([{", ".join(f"'{w}'" for w in STOP_WORDS)}], lower(x)))) AS BIGINT) AS n_stop_words
    FROM parts LEFT JOIN covered USING (r)
),
based AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts)
SELECT *, NOT base_failed AND {" AND ".join(rule.sql() for rule in RULES)} AS kept FROM based
"""

"""Toxicity scores: a bidirectional gated recurrent network trained in numpy on labelled rows.

The network sees the text only. It is fitted in one task on a bounded sample: per class the first PER_CLASS labelled
documents in hash order, of texts up to SAMPLE_CHARS characters; the driver gets the weights, some megabytes. Scoring is a
narrow map over all texts in full.

Defined results: NULL and empty texts score what the network gives without words; without labelled rows of both
classes the score is 0; of several labels of one id the greatest counts; rows without an id are scored and not
learned from; a column named like the output is replaced; repeated rows score alike; an empty frame gives an empty frame.
"""

import pickle

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from wardlog.llm import gru
from wardlog.llm.columns import map_arrow, on_workers
from wardlog.llm.words import table

PER_CLASS = {0: 2000, 1: 1000}
SAMPLE_CHARS = 20_000
SEED = "toxic"


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string")) % 5 == 0, F.lit(False))


def sample_rows(df: DataFrame, labels: DataFrame, id="doc_id", text="text", label="toxic") -> DataFrame:
    """label, place (hash order), text: the sample for training. Ids are drawn among labelled ids of documents, so only drawn texts are gathered."""
    clear = labels.filter(F.col(id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(id))).groupBy(
        F.col(id).alias("labelled")).agg(F.max(label).alias("label"))
    own = df.select(F.col(f"`{id}`").alias("own"), F.col(f"`{text}`").alias("text")).filter(F.length("text") <= SAMPLE_CHARS)
    present = clear.join(own.select("own"), F.col("own") == F.col("labelled"), "left_semi")
    order = F.md5(F.concat(F.lit(SEED), F.col("labelled").cast("string")))
    drawn = None
    for kind, limit in PER_CLASS.items():
        some = present.filter(F.col("label") == kind).orderBy(order).limit(limit)
        drawn = some if drawn is None else drawn.union(some)
    rows = own.join(F.broadcast(drawn), F.col("own") == F.col("labelled"))  # one row per id drawn
    return rows.groupBy("labelled", "label").agg(F.min("text").alias("text")).select("label", order.alias("place"), "text")


def labelled_sample(df: DataFrame, labels: DataFrame, **names) -> tuple[list[str], list[int]]:
    """Texts and labels of the sample, in the order in which they are trained on."""
    found = sample_rows(df, labels, **names).orderBy("label", "place").collect()
    return [r["text"] for r in found], [r["label"] for r in found]


def train_toxicity(df: DataFrame, labels: DataFrame, **names) -> gru.Network | None:
    """Fits the network in one task on the sample; None without labelled rows of both classes."""
    def fit(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("label", "ascending"), ("place", "ascending")])
        known = rows["label"].to_pylist()
        found = gru.train(rows["text"].to_pylist(), known) if len(set(known)) == 2 else None
        return pa.table({"network": pa.array([pickle.dumps(found)], pa.binary())})

    on_workers(df.sparkSession)
    sample = sample_rows(df, labels, **names).withColumn("all", F.lit(0))
    found = sample.groupBy("all").applyInArrow(fit, "network binary").collect()  # bounded by PER_CLASS and SAMPLE_CHARS
    return pickle.loads(found[0]["network"]) if found else None


def score_toxicity(df: DataFrame, network: gru.Network | None, text="text", out="toxicity") -> DataFrame:
    """df with a score for every row."""
    rest = df.drop(out)
    if network is None:
        return rest.withColumn(out, F.lit(0.0))
    shared = df.sparkSession.sparkContext.broadcast(network)  # some megabytes, whatever the data

    def run(batches):
        for batch in batches:
            score = pa.array(shared.value.scores(batch.column(batch.schema.get_field_index(text))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, out])

    return map_arrow(rest, run, StructType(list(rest.schema.fields)).add(out, DoubleType()))


def op1_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = train_toxicity(documents, table(spark, sf_dir, "labels"))
    scored = score_toxicity(documents, network, out="score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

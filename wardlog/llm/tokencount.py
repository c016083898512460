"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the pieces that end at every position; dynamic programming carries the best
score and its piece count, with no back pointers. Ties fall as in unigram tokenizers: of equal scores the piece that begins first
wins, an unknown character only where no piece is that character. Unknown characters count one token per byte.
Scores add in 64-bit floats; the sums of the whole-number scores of the public vocabulary are exact.

Defined results: NULL and empty texts have no tokens; a text of any length is solved chunk by chunk; repeated rows get
equal counts; a column named like an output is replaced; an empty frame gives an empty frame.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from wardlog.llm.columns import map_arrow
from wardlog.llm.lattice import Automaton, Chunks, Lattice, Vocabulary, automaton, blocks_of
from wardlog.llm.words import table


def count_tokens(column, machine: Automaton) -> tuple[np.ndarray, np.ndarray]:
    counts, scores = np.zeros(len(column), np.int64), np.zeros(len(column))
    for i, j, data, offsets in blocks_of(column):
        chunks = Chunks(data, offsets, machine)
        if not len(chunks.starts):
            continue
        score, count = Lattice(data, chunks, machine).best()
        row = np.repeat(np.arange(i, j), chunks.per_row)
        np.add.at(counts, row, count[chunks.kind])
        np.add.at(scores, row, score[chunks.kind])
    return counts, scores


def token_counts(df: DataFrame, model_path: str, text="text", tokens="n_tokens", score="score") -> DataFrame:
    """df with the number of tokens and the best segmentation's score of every text: a narrow map."""
    rest = df.drop(tokens, score)
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.read(model_path))  # one vocabulary, about 1 MB

    def run(batches):
        machine = automaton(shared.value)
        for batch in batches:
            count, best = count_tokens(batch.column(batch.schema.get_field_index(text)), machine)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(count), pa.array(best)], names=[*batch.schema.names, tokens, score])

    return map_arrow(rest, run, StructType(list(rest.schema.fields)).add(tokens, LongType()).add(score, DoubleType()))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_token_counts(spark, sf_dir, model_path: str | None = None):
    counted = token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), model_path or default_model())
    return counted.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), "n_tokens", "score")

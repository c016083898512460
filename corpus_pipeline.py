"""From raw documents to sampled encodings in five stages.

Each stage works on all documents its predecessor kept, and its decisions take effect: rejected documents, toxic ones and
copies go, the mix repeats or leaves out documents, and what is left is encoded. All stages but the last return the
columns of documents. Between stages the rows are a table in the shared folder, so a lost executor costs a re-read.

For every stage: an empty frame gives an empty frame; rows of equal id or text are rows of their own unless the stage says
otherwise; texts of any length are read whole; rows without an id, language or source stay rows; other columns, whatever their
names, are carried along.
"""

from pyspark.sql import functions as F

from wardlog.llm.minhash import without_near_duplicates
from wardlog.llm.mixing import mixed_documents
from wardlog.llm.quality import quality_rules
from wardlog.llm.sampling import sample_encodings
from wardlog.llm.tokencount import default_model
from wardlog.llm.toxicity import score_toxicity, train_toxicity
from wardlog.llm.words import table
from wardlog.session import materialize

TOXIC = 0.5


def _new_name(docs, name):
    """A column name that the documents do not have."""
    while name in docs.columns:
        name += "_"
    return name


def quality(spark, docs, sf_dir):
    """Documents that pass the quality rules. NULL and empty texts have no words and go; equal texts are judged alike."""
    verdict = _new_name(docs, "verdict")
    judged = quality_rules(docs, out=verdict)
    return judged.filter(F.col(verdict)["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def toxicity(spark, docs, sf_dir):
    """Documents that a network, trained on the labelled ones among them, scores below TOXIC. Without labelled rows of
    both classes all stay; NULL and empty texts get the score of no words."""
    network = train_toxicity(docs, table(spark, sf_dir, "labels"))
    score = _new_name(docs, "score")
    scored = score_toxicity(docs, network, out=score)
    return scored.filter(F.col(score) < TOXIC).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates: five-word shingles, likeness of 0.8 or more. Of a group the smallest
    id stays; texts without words resemble nothing and stay."""
    return without_near_duplicates(docs, shingle=5, percent=80)


def mixing(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them, from not at all to three times; those without words go. NULL
    is a source of its own."""
    return mixed_documents(docs)


def sentencepiece(spark, docs, sf_dir):
    """Sampled encodings: doc_id, sample, ids, log_prob, inclusion. Samples are seeded by doc_id, so equal rows get equal
    samples; texts without characters have one encoding, without ids."""
    return sample_encodings(docs, default_model()).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding and decoding", sentencepiece),
]

# A trained network and sampled encodings are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Token counts as rollups that signed deltas maintain.

An event is one of

* ``insert``: a document arrives with its count: +1 document, +count tokens;
* ``delete``: a document goes with the count it was entered with: -1 document, -count tokens;
* ``revise``: the count of a document changes: 0 documents, new - old tokens.

Totals by source, language and tokenizer version are sums of deltas, so a batch is reduced to one row per
key and kind before it is stored, and totals never need the documents again. A batch is committed under an
id: its folder holds the reduced rows and Spark's success marker. Committing an id that has the marker does
nothing; a folder without it, left by a job that died, is written anew. Sums are order-free: batches may be
committed in any order.

Nulls: a null source or language is a key of its own, a null text has no tokens, an event whose count is
null counts 0 tokens. Rows that repeat are counted as often as they occur. Empty batches and ledgers give
empty totals. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.session import materialize, scratch_path

KEYS = ["source", "lang", "version"]
TOKENIZERS = "/opt/tokenizers"
BPE = "byte_bpe_50k"
# Fixed value: the split pattern that the vocabulary file was built with.
BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_EVENTS = "source string, lang string, version string, kind string, docs long, tokens long"


def load_encoder(folder: str, vocabulary: str, pattern: str = BPE_PATTERN):
    """A byte-level encoder from a ranks file; every executor has the folder."""
    import tiktoken

    with open(f"{folder}/{vocabulary}.tiktoken", "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(vocabulary, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def without_repeated_lines(text: str) -> str:
    """``text`` without lines that occurred before in it; empty lines stay."""
    lines = text.split("\n")
    seen = set()
    kept = [x for x in lines if not x or not (x in seen or seen.add(x))]
    return text if len(kept) == len(lines) else "\n".join(kept)


def count_tokens(docs: DataFrame, folder: str = TOKENIZERS, vocabulary: str = BPE, pattern: str = BPE_PATTERN) -> DataFrame:
    """(doc_id, source, lang, text_key, version, n, revised) of every document and tokenizer version.

    Version ``words-1`` counts runs without ASCII white space, the other is the vocabulary's name. ``revised``
    is the count without repeated lines. ``text_key`` is a digest of the text.
    """

    def run(batches):
        encoder = load_encoder(folder, vocabulary, pattern)
        for batch in batches:
            keys, words, pieces, words2, pieces2 = [], [], [], [], []
            for text in batch.column(3).to_pylist():
                text = text or ""
                slim = without_repeated_lines(text)
                n, m = len(text.encode("utf-8", "surrogatepass").split()), len(encoder.encode_ordinary(text))
                same = slim is text
                keys.append(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest())
                words.append(n)
                pieces.append(m)
                words2.append(n if same else len(slim.encode("utf-8", "surrogatepass").split()))
                pieces2.append(m if same else len(encoder.encode_ordinary(slim)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(keys, pa.string()), *[pa.array(x, pa.int64()) for x in (words, words2, pieces, pieces2)]],
                ["doc_id", "source", "lang", "text_key", "w", "w2", "p", "p2"],
            )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    wide = plain.mapInArrow(run, "doc_id long, source string, lang string, text_key string, w long, w2 long, p long, p2 long")
    version = lambda name, n, revised: F.struct(F.lit(name).alias("version"), F.col(n).alias("n"), F.col(revised).alias("revised"))
    return wide.select("doc_id", "source", "lang", "text_key", F.inline(F.array(version("words-1", "w", "w2"), version(vocabulary, "p", "p2"))))


def _events(rows: DataFrame, kind: str, docs: int, tokens: Column) -> DataFrame:
    return rows.select(*KEYS, F.lit(kind).alias("kind"), F.lit(docs).cast("long").alias("docs"), F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"))


def inserts(rows: DataFrame, count: str = "n") -> DataFrame:
    return _events(rows, "insert", 1, F.col(count))


def deletes(rows: DataFrame, count: str = "n") -> DataFrame:
    return _events(rows, "delete", -1, -F.col(count))


def revisions(rows: DataFrame, old: str = "n", new: str = "revised") -> DataFrame:
    """Deltas of the rows whose count changed."""
    return _events(rows.where(~F.col(old).eqNullSafe(F.col(new))), "revise", 0, F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0)))


def _committed(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def commit(events: DataFrame, ledger: str, batch: str) -> bool:
    """Store the batch under its id unless it is stored already; whether this call stored it."""
    path = f"{ledger}/batch={batch}"
    if _committed(events.sparkSession, path):
        return False
    rows = events.groupBy(*KEYS, "kind").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    rows.write.mode("overwrite").parquet(path)
    return True


def totals(spark: SparkSession, ledger: str, batches: list[str]) -> DataFrame:
    """Totals by key over the given committed batches, with the tokens each kind of event moved."""
    paths = [p for b in dict.fromkeys(batches) if _committed(spark, p := f"{ledger}/batch={b}")]
    rows = spark.read.schema(_EVENTS).parquet(*paths) if paths else spark.createDataFrame([], _EVENTS)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("tokens"))), F.lit(0))
    return rows.groupBy(*KEYS).agg(
        F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"),
        of("insert").alias("inserted"), of("delete").alias("deleted"), of("revise").alias("revised"),
    )


def rollup_history(docs: DataFrame, folder: str = TOKENIZERS, vocabulary: str = BPE) -> DataFrame:
    """Totals after three batches over all documents, one of them sent twice.

    ``load`` inserts every document, ``copies`` deletes documents whose text a smaller doc_id has too,
    ``lines`` revises the counts of the rest to texts without repeated lines.
    """
    spark = docs.sparkSession
    counted = materialize(count_tokens(docs, folder, vocabulary), "counts")
    firsts = counted.groupBy("text_key").agg(F.min("doc_id").alias("first"))
    marked = counted.join(firsts, "text_key")
    copy = F.col("doc_id") > F.col("first")
    ledger = scratch_path(spark, "ledger")
    commit(inserts(counted), ledger, "load")
    for _ in range(2):  # the second arrival changes nothing
        commit(deletes(marked.where(copy)), ledger, "copies")
    commit(revisions(marked.where(~F.coalesce(copy, F.lit(False)))), ledger, "lines")
    return totals(spark, ledger, ["load", "copies", "lines"])

"""Rule-based quality: fixed limits on a document, and line frequency across documents.

Base rules: too few words, or too many words in repeated three-word windows, fail a document.

Across documents: lines are normalised (lower case, digits as 0, blanks as one space) and hashed.
For each host the distinct documents of a line are counted; documents with equal text are one
document, so that an exact copy makes no line frequent. A line is removed where it is in more than
``most_documents`` of the host's documents; the limit is the same in small and large hosts and tables.
A document left with less than ``left`` of its words is depleted and rejected.

The host of a document is its source. A null source is a host of its own; null texts are empty and
fail the base rules. Repeated rows are judged alike and kept as rows. Only hashes of lines are
shuffled, once per document and line, and counts are merged before the shuffle, so a line that all
documents share costs one row per task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from crowdpulse.llm.tables import staged, text_of

SYMBOLS = b"#*$%&|<>"
MOST_DOCUMENTS, LEFT, LEAST_WORDS, MOST_REPEATED = 20, 0.5, 50, 50
ZEROS = bytes.maketrans(b"123456789", b"000000000")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more."""
    windows = Counter(zip(words, words[1:], words[2:]))
    if len(windows) == max(0, len(words) - 2):
        return 0
    again = np.fromiter((windows[w] > 1 for w in zip(words, words[1:], words[2:])), bool, len(words) - 2)
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def judge(text: str) -> tuple[int, int, int, int, int]:
    """The counts of ``COUNTS``."""
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def counted(text: Column) -> Column:
    """The base counts as a struct of longs."""

    @arrow_udf(f"struct<{','.join(f'{c}:bigint' for c in COUNTS)}>")
    def run(texts: pa.Array) -> pa.Array:
        rows = np.array([judge(t.as_py() or "") for t in texts], np.int64).reshape(-1, len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(COUNTS))], list(COUNTS))

    return run(text)


def line_rows(docs: DataFrame) -> DataFrame:
    """(source, text_hash, line, words) for every distinct line of a text; words count all its occurrences."""
    own = docs.select("source", F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, hashes, sizes = [], [], []
            for k, text in enumerate(batch.column("text")):
                found: dict[int, int] = {}
                for line in text.as_py().lower().encode().translate(ZEROS).split(b"\n"):
                    words = line.split()
                    if words:
                        h = xxhash.xxh64_intdigest(b" ".join(words))
                        found[h] = found.get(h, 0) + len(words)
                at += [k] * len(found)
                hashes += found.keys()
                sizes += found.values()
            at = pa.array(at, pa.int32())
            line = pa.array(np.array(hashes, np.uint64).view(np.int64))
            owner = [batch.column(c).take(at) for c in ("source", "text_hash")]
            yield pa.RecordBatch.from_arrays(
                [*owner, line, pa.array(sizes, pa.int32())], ["source", "text_hash", "line", "words"]
            )

    kind = docs.schema["source"].dataType.simpleString()
    return own.mapInArrow(run, f"source {kind}, text_hash long, line long, words int")


def frequent_lines(lines: DataFrame, most_documents: int = MOST_DOCUMENTS) -> DataFrame:
    """(source, line) over the limit; ``lines`` has one row per source, text and line."""
    counts = lines.groupBy("source", "line").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > most_documents).select("source", "line")


def judged(
    docs: DataFrame,
    most_documents: int = MOST_DOCUMENTS,
    left: float = LEFT,
    least_words: int = LEAST_WORDS,
    most_repeated: int = MOST_REPEATED,
) -> DataFrame:
    """One row per document: doc_id, source, the base counts, removed_words, base_failed, kept."""
    base = docs.select("doc_id", "source", F.xxhash64(text_of()).alias("text_hash"), counted(text_of()).alias("c"))
    base = staged(base.select("doc_id", "source", "text_hash", "c.*"), "base")
    # Copies of a text within a host are one document.
    lines = staged(line_rows(docs).dropDuplicates(["source", "text_hash", "line"]), "lines")
    often = frequent_lines(lines, most_documents).toDF("_host", "_line")
    gone = lines.join(often, F.col("source").eqNullSafe(F.col("_host")) & (F.col("line") == F.col("_line")))
    gone = gone.groupBy("_host", F.col("text_hash").alias("_text")).agg(F.sum("words").alias("removed_words"))
    on = F.col("source").eqNullSafe(F.col("_host")) & (F.col("text_hash") == F.col("_text"))
    removed = F.coalesce("removed_words", F.lit(0)).alias("removed_words")
    joined = base.join(gone, on, "left").select("doc_id", "source", *COUNTS, removed)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    enough = F.col("n_words") - F.col("removed_words") >= left * F.col("n_words")
    return joined.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & enough)

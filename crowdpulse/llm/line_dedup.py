"""Repeated passages, found with content-defined chunks of lines and removed after a byte comparison.

A line ends at a line feed, and within a long physical line where the hash of two neighbouring words
is less than that of the pairs beside it; so a passage pasted into the middle of a paragraph has the
same lines as its original, of two to five words as a rule. A rolling hash over line hashes (a line and
the one before) chooses the chunks: a chunk begins where it is less than at the lines beside it, so text
inserted or deleted elsewhere moves no boundary, and a stretch of more than ``most_lines`` lines without
such a place is cut every two lines from its beginning. Every chunk has at least two lines (but for a
text of one line, which is none).

Chunks whose hash occurs more than once anywhere are candidates. Their bytes are then compared; the
first occurrence by (doc_id, hash of the text, place) stays. Later ones in a row make a run, and a run
grows word by word to both sides as long as the words equal those around the first occurrence of its
first and last chunk, up to ``grow`` words or, where the chunk beside the first occurrence is a
candidate itself, to the end of that chunk. Runs of ``min_words`` words go.

Copies of a whole text are not cut at all: the one with the least doc_id stands for them, and the
others lose everything if they have ``min_words`` words. Null and empty texts pass
unchanged. Rows with equal doc_id and text count as one document and get the same decision. A null
doc_id sorts before all others. Very long texts are cut whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from crowdpulse.llm import words as W
from crowdpulse.llm.tables import drop, packed, release, staged, text_of, unpacked

#: Longest stretch of lines that is no further cut, least words in a removed passage, words a run may
#: grow by on either side.
MOST_LINES, MIN_WORDS, GROW = 4, 15, 40
TEXT = ("h1", "h2")  # of a text, 128 bits together
KEY = ("doc_id", *TEXT)
RANK = W.powers(0xD6E8FEB86659FD93, 4096)


def _hashes() -> list:
    text = text_of()
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def least_of_neighbours(hash: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places with a smaller hash than the one before and none greater than the one after, in one owner."""
    out = np.zeros(len(hash), bool)
    same = owner[1:] == owner[:-1]
    inner = same[:-1] & same[1:]
    out[1:-1] = inner & (hash[1:-1] < hash[:-2]) & (hash[1:-1] <= hash[2:])
    return out


def previous(hash: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.concatenate([[np.uint64(0)], hash[:-1]])
    out[first] = 0
    return out


def since(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of the members of groups that begin ``at`` places, the number in their group."""
    return np.arange(size.sum()) - np.repeat(at, size)


def cut(part: W.Texts, w: W.Words | None = None, most_lines: int = MOST_LINES):
    """Chunks of a slice: owner, number in the text, byte places in the text, words, lines, hash."""
    w = W.words(part) if w is None else w
    n = len(w.hash)
    if n < 2:
        return *[np.zeros(0, np.int64)] * 6, np.zeros(0, np.uint64)
    new_text = np.ones(n, bool)
    np.not_equal(w.text[1:], w.text[:-1], out=new_text[1:])
    pair = W.mix(w.hash + previous(w.hash, new_text) * W.BASE)
    new_line = new_text | least_of_neighbours(pair, w.text)
    after_feed = np.searchsorted(w.start, np.flatnonzero(part.bytes == 10))
    new_line[after_feed[after_feed < n]] = True
    line_at = np.flatnonzero(new_line)
    rank = since(line_at, np.diff(line_at, append=n))
    line = np.add.reduceat(w.hash * RANK[rank & len(RANK) - 1], line_at)
    first_line = new_text[line_at]
    rolling = W.mix(line + previous(line, first_line) * W.BASE)
    new_chunk = least_of_neighbours(rolling, w.text[line_at])
    new_chunk[1:] &= ~first_line[:-1]  # a text's first chunk has two lines too
    new_chunk |= first_line
    # Long stretches: every second line, but no single line at the end.
    at = np.flatnonzero(new_chunk)
    size = np.diff(at, append=len(line_at))
    offset, size = since(at, size), np.repeat(size, size)
    new_chunk |= (size > most_lines) & (offset & 1 == 0) & (size - offset >= 2)
    chunk_line = np.flatnonzero(new_chunk)
    chunk_at = line_at[chunk_line]
    stop = np.append(chunk_at[1:], n)
    lines = np.diff(chunk_line, append=len(line_at))
    owner = w.text[chunk_at]
    starts_text = new_text[chunk_at]
    first_chunk = np.flatnonzero(starts_text)
    number = since(first_chunk, np.diff(first_chunk, append=len(chunk_at)))
    origin = part.starts[owner]
    rank = since(chunk_line, lines)
    digest = W.mix(np.add.reduceat(W.mix(line) * RANK[rank & len(RANK) - 1], chunk_line))
    found = owner, number, w.start[chunk_at] - origin, w.end[stop - 1] - origin, stop - chunk_at, lines, digest
    return tuple(column[lines > 1] for column in found)


def chunks(docs: DataFrame) -> DataFrame:
    """(key, chunk, known, deal): the distinct chunk hashes of every text, those that a batch has more than
    once as known to be repeated, and the value to deal them out by.

    Of a batch only the first row of a known chunk goes where all of that chunk go; so a task gets of a
    very common chunk a row for each batch, not for each text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, row = np.unique(batch.column("key").to_numpy(), return_index=True)  # copies are cut once
            found = [(part.first, cut(part)) for part in W.texts(batch.column("text").take(pa.array(row)))]
            if not sum(len(c[-1]) for _, c in found):
                continue
            owner = np.concatenate([c[0] + at for at, c in found])
            chunk = np.concatenate([c[-1].view(np.int64) for _, c in found])
            order = np.argsort(chunk)
            owner, chunk = owner[order], chunk[order]
            same = chunk[1:] == chunk[:-1]
            known = np.append(same, False) | np.insert(same, 0, False)
            again = np.flatnonzero(known)
            again = again[np.lexsort((owner[again], chunk[again]))]
            o, c = owner[again], chunk[again]
            new_chunk, new = np.ones(len(c), bool), np.ones(len(c), bool)
            new_chunk[1:] = c[1:] != c[:-1]
            new[1:] = new_chunk[1:] | (o[1:] != o[:-1])
            single = np.flatnonzero(~known)
            owners, chunk = np.concatenate([owner[single], o[new]]), np.concatenate([chunk[single], c[new]])
            apart = np.concatenate([np.zeros(len(single), bool), ~new_chunk[new]])
            keys, known = key[owners], np.arange(len(owners)) >= len(single)
            columns = [pa.array(x) for x in (keys, chunk, known, np.where(apart, keys, chunk))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "chunk", "known", "deal"])

    keyed = docs.select(F.xxhash64(text_of()).alias("key"), text_of().alias("text"))
    return keyed.mapInArrow(run, "key long, chunk long, known boolean, deal long")


def whole_groups(batches: Iterator[pa.RecordBatch], by: str, rows: int = 1 << 16) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches sorted by a column of longs as tables of ``rows`` rows or more that part none of its groups,
    with the places where the groups begin."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(len(b) for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        at = group_starts(table.column(by).to_numpy())
        if len(at) > 1:
            yield table.slice(0, at[-1]), at[:-1]
        held = table.slice(at[-1]).combine_chunks().to_batches()
    if sum(len(b) for b in held):
        table = pa.Table.from_batches(held)
        yield table, group_starts(table.column(by).to_numpy())


def group_starts(value: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(key, chunks): of every text the chunk hashes that occur more than once anywhere, sorted."""

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, "chunk"):
            key, known = table.column("key").to_numpy(), table.column("known").to_numpy()
            often = np.minimum.reduceat(key, at) != np.maximum.reduceat(key, at)
            often |= np.logical_or.reduceat(known, at)
            kept = np.flatnonzero(np.repeat(often, np.diff(at, append=len(key))))
            chunk = table.column("chunk").to_numpy()[kept]
            yield pa.RecordBatch.from_arrays([pa.array(key[kept]), pa.array(chunk)], ["key", "chunk"])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, "key"):
            key, chunk = table.column("key").to_numpy(), table.column("chunk").to_numpy()
            new = np.ones(len(key), bool)
            new[1:] = chunk[1:] != chunk[:-1]
            new[at] = True
            ends = np.cumsum(np.add.reduceat(new, at, dtype=np.int64))
            offsets = np.concatenate([[0], ends])
            own = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(chunk[new]))
            yield pa.RecordBatch.from_arrays([pa.array(key[at]), own], ["key", "chunks"])

    dealt = chunks(docs).repartition("deal").sortWithinPartitions("chunk").select("key", "chunk", "known")
    often = dealt.mapInArrow(several, "key long, chunk long")
    return often.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(lists, "key long, chunks array<long>")


def firsts(docs: DataFrame) -> DataFrame:
    """(h1, h2, first, copied): for each text the least doc_id, and whether there is another one."""
    own = docs.select("doc_id", *_hashes()).groupBy(*TEXT)
    # Least and greatest by themselves, as a struct's would be found by sorting.
    least, most, without = F.min("doc_id"), F.max("doc_id"), F.count("*") > F.count("doc_id")
    return staged(
        own.agg(
            F.struct(F.when(~without, least).alias("doc_id")).alias("first"),
            F.coalesce(F.when(without, least.isNotNull()).otherwise(least < most), F.lit(False)).alias("copied"),
        ),
        "first-copies",
    )


def repeated(docs: DataFrame, first: DataFrame, grow: int = GROW) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The candidates, every one but the first of each set of byte-equal chunks beside that first, and the
    staged tables the latter are read from.

    Candidates have their owner, number, places, hash and bytes, and the words around them where the
    chunk beside them is no candidate.
    """
    spark = docs.sparkSession
    # Of the copies of a text one is compared.
    listed = repeated_chunks(docs).join(first.select(F.col("h1").alias("key"), "h2", "first"), "key")
    listed = staged(listed, "repeated-chunks")
    release(spark)

    names = ["number", "start", "end", "chunk"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("chunks")
            offsets, wanted = lists.offsets.to_pylist(), lists.values.to_numpy()  # sorted, and never empty
            for part in W.texts(batch.column("text")):
                w = W.words(part)
                owner, number, start, end, _, _, digest = cut(part, w)
                digest = digest.view(np.int64)
                edges = np.searchsorted(owner, np.arange(part.last - part.first + 1)).tolist()
                at = offsets[part.first : part.last + 1]
                hit = np.zeros(len(owner), bool)
                for a, b, c, d in zip(edges, edges[1:], at, at[1:]):
                    own = digest[a:b]
                    hit[a:b] = wanted[c:d].take(wanted[c:d].searchsorted(own), mode="clip") == own
                hits = np.flatnonzero(hit)
                origin, whole = part.starts[owner], part.ends[owner]
                first, last = (origin + start)[hits], (origin + end)[hits]
                before, after = around(w, origin[hits], whole[hits], first, last, grow)
                # A neighbour that is a candidate itself speaks for the words there.
                follows = (np.diff(number[hits]) == 1) & (np.diff(owner[hits]) == 0)
                bounds = (first, last), (np.where(np.insert(follows, 0, False)[: len(hits)], -1, before), first)
                bounds += ((last, np.where(np.append(follows, False)[: len(hits)], -1, after)),)
                data = part.bytes.tobytes()
                at = pa.array(owner[hits] + part.first)
                numbers = [pa.array(x[hits]) for x in (number, start, end, digest)]
                pieces = [
                    pa.array([data[a:b] if min(a, b) >= 0 else None for a, b in zip(x.tolist(), y.tolist())], pa.binary())
                    for x, y in bounds
                ]
                owners = [batch.column(c).take(at) for c in KEY]
                yield pa.RecordBatch.from_arrays([*owners, *numbers, *pieces], [*KEY, *names, "bytes", "before", "after"])

    keyed = docs.select("doc_id", *_hashes(), text_of().alias("text")).join(
        listed.withColumnRenamed("h2", "_h2"), (F.col("h1") == F.col("key")) & (F.col("h2") == F.col("_h2"))
    )
    owners = keyed.where(F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).select(*KEY, "text", "chunks")
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"{n} long" for n in names)
    shape = f"doc_id {kind}, h1 long, h2 long, {numbers}, bytes binary, before binary, after binary"
    candidates = staged(owners.mapInArrow(run, shape), "chunk-bytes")
    drop(listed)
    release(spark)
    # Equal hashes are only candidates: rows are grouped by the bytes themselves.
    own = F.struct(*KEY, "number")
    equal = candidates.groupBy("chunk", "bytes").agg(F.min(own).alias("first"), F.count("*").alias("n"))
    equal = staged(equal, "equal-chunks")
    release(spark)
    # Where all chunks of a hash have the same bytes, the hash stands for them from here on.
    mixed = staged(equal.groupBy("chunk").count().where("count > 1").select("chunk"), "mixed-chunks")
    several = equal.where("n > 1")
    rows = candidates.drop("before", "after")
    alike = rows.drop("bytes").join(several.select("chunk", "first").join(mixed, "chunk", "left_anti"), "chunk")
    unlike = rows.join(mixed, "chunk", "left_semi").join(several.drop("n"), ["chunk", "bytes"]).drop("bytes")
    later = alike.unionByName(unlike).where(~own.eqNullSafe(F.col("first")))
    return candidates, later.select(*TEXT, "number", "start", "end", "first"), [equal, mixed]


def around(w: W.Words, origin, whole, first, last, grow: int) -> tuple[np.ndarray, np.ndarray]:
    """For spans of a slice, where ``grow`` words before them begin and ``grow`` words after them end."""
    k = np.searchsorted(w.start, first)  # number of the span's first word
    j = np.searchsorted(w.start, last)  # of the first word after it
    low = np.searchsorted(w.start, origin)
    high = np.searchsorted(w.start, whole)
    if not len(w.start):
        return first, last
    a, b = np.maximum(low, k - grow), np.minimum(high, j + grow)
    before = np.where(a < k, w.start[np.minimum(a, len(w.start) - 1)], first)
    after = np.where(b > j, w.end[b - 1], last)
    return before, after


def runs(later: DataFrame) -> DataFrame:
    """Chunks in a row as one: places, and the first occurrences of the first and the last of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in whole_groups(batches, "h1"):
            table = table.combine_chunks()
            h1, h2, number = (table.column(n).to_numpy() for n in (*TEXT, "number"))
            new_text = np.ones(len(number), bool)
            new_text[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            # A chunk listed twice, for a repeated row, is one.
            step = np.diff(number)
            begins = new_text.copy()
            begins[1:] |= (step != 0) & (step != 1)
            at = np.flatnonzero(begins)
            to = np.append(at[1:], len(number)) - 1
            first_run = np.flatnonzero(new_text[at])
            run = since(first_run, np.diff(first_run, append=len(at)))
            begin, finish = table.take(pa.array(at)), table.take(pa.array(to))
            columns = [begin.column("h1"), begin.column("h2"), pa.chunked_array([pa.array(run)])]
            columns += [begin.column("start"), finish.column("end"), begin.column("first"), finish.column("first")]
            names = [*TEXT, "run", "start", "end", "first", "last"]
            yield from pa.Table.from_arrays(columns, names).to_batches()

    place = "struct<h1:bigint,h2:bigint,number:bigint>"
    rows = later.select(*TEXT, "number", "start", "end", F.struct("first.h1", "first.h2", "first.number").alias("first"))
    rows = rows.repartition(*TEXT).sortWithinPartitions(*TEXT, "number")
    return rows.mapInArrow(run, f"h1 long, h2 long, run long, start long, end long, first {place}, last {place}")


def passages(docs: DataFrame, first: DataFrame, grow: int = GROW) -> DataFrame:
    """The runs of each text: places, and the words beside the first occurrences of their ends."""
    candidates, later, read = repeated(docs, first, grow)
    found = staged(runs(later), "runs")
    drop(*read)
    release(docs.sparkSession)
    # Each end asks for the words beside it, and for the chunk beside it: one of them is there, or neither.
    asked = [(side, F.col(at), step) for side, at, step in ((0, "first", -1), (1, "last", 1))]
    lookups = F.array(
        *[
            F.struct(F.lit(side).alias("side"), at["h1"].alias("o1"), at["h2"].alias("o2"), (at["number"] + n).alias("o3"), F.lit(n != 0).alias("beside"))
            for side, at, step in asked
            for n in (0, step)
        ]
    )
    ends = found.select(*TEXT, "run", F.explode(lookups).alias("e")).select(*TEXT, "run", "e.*")
    rows = candidates.select(
        F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("number").alias("o3"), "bytes", "before", "after"
    )
    own = F.when(F.col("side") == 0, F.col("before")).otherwise(F.col("after"))
    beside = ends.join(rows, ["o1", "o2", "o3"]).withColumn("words", F.when(F.col("beside"), F.col("bytes")).otherwise(own))
    # The nearest words: its own ones, else the chunk beside it.
    words = [F.min_by("words", F.when(F.col("words").isNotNull() & (F.col("side") == k), F.col("beside"))).alias(n) for k, n in ((0, "before"), (1, "after"))]
    beside = beside.groupBy(*TEXT, "run").agg(*words)
    whole = found.select(*TEXT, "run", "start", "end").join(beside, [*TEXT, "run"], "left")
    span = F.struct("start", "end", "before", "after")
    out = whole.groupBy(*TEXT).agg(F.array_sort(F.collect_list(span)).alias("found"))
    out = staged(out, "passages")
    drop(candidates, found)
    release(docs.sparkSession)
    return out


def common(own: list[bytes], other: list[bytes]) -> int:
    """Words that agree from the beginning."""
    n = 0
    while n < len(own) and n < len(other) and own[n] == other[n]:
        n += 1
    return n


def grown(text: bytes, start: int, end: int, before: bytes, after: bytes) -> tuple[int, int]:
    """A span and the words to both sides that equal those around the first occurrence."""
    theirs = before.split()
    if theirs:
        low = max(0, start - 4 * len(before) - 64)
        own = text[low:start].split()[low > 0 :]  # the first one may be cut
        n = common(own[::-1], theirs[::-1])
        for word in own[::-1][:n]:
            start = text.rindex(word, 0, start)
    theirs = after.split()
    if theirs:
        high = end + 4 * len(after) + 64
        own = text[end:high].split()
        own = own[: len(own) - (high < len(text))]
        for word in own[: common(own, theirs)]:
            end = text.index(word, end) + len(word)
    return start, end


def spans_of(text: bytes, found: list[dict], min_words: int) -> list[tuple[int, int]]:
    """Byte places of the passages: runs grown to both sides, with ``min_words`` words."""
    spans: list[list[int]] = []
    for run in found:
        start, end = grown(text, run["start"], run["end"], run["before"] or b"", run["after"] or b"")
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return [(a, b) for a, b in spans if len(text[a:b].split()) >= min_words]


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans, each with the separator that would be left over."""
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        before, after = text[start - 1 : start], text[end : end + 1]
        at = end + (after == b" " and before in b"\n " or after == b"\n" and before in b"\n")
    out.append(text[at:])
    kept = b"".join(out)
    return b"" if spans and not kept.strip() else kept


def remove_repeated(
    docs: DataFrame, min_words: int = MIN_WORDS, grow: int = GROW, count: str = "removed_words"
) -> DataFrame:
    """``docs`` without repeated passages; adds ``count`` (int, null where nothing went).

    All other columns pass unchanged; ``text`` is rewritten. A column named like ``count`` is an error
    of the caller, named as such.
    """
    if count in docs.columns:
        raise ValueError(f"the input has a column {count}; give the count another name")

    @arrow_udf("struct<text:string,removed_words:int>")
    def cleaned(text: pa.Array, found: pa.Array, copy: pa.Array) -> pa.Array:
        flags, present = copy.to_pylist(), found.is_valid().to_pylist()
        texts, gone = [None] * len(text), [None] * len(text)
        for k, is_copy in enumerate(flags):
            if not text[k].is_valid or not (is_copy or present[k]):
                continue
            whole = text[k].as_buffer().to_pybytes()
            n = len(whole.split())
            if is_copy:
                spans = [(0, len(whole))] if n >= min_words else []
            else:
                spans = spans_of(whole, found[k].as_py(), min_words)
            if spans:
                kept = without(whole, spans)
                texts[k], gone[k] = kept.decode(), n - len(kept.split())
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(gone, pa.int32())], ["text", "removed_words"])

    first = firsts(docs)
    verdicts = first.join(passages(docs, first, grow), [*TEXT], "left").where("copied or found is not null")
    verdicts = verdicts.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first", F.col("found").alias("_found"))
    rows = packed(docs, *_hashes())
    joined = rows.join(verdicts, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    # The text goes through the shuffle once, in its row.
    doc_id, text = (F.col("_doc").getField(c) for c in ("doc_id", "text"))
    is_copy = F.col("first").isNotNull() & ~doc_id.eqNullSafe(F.col("first.doc_id"))
    # Only texts that may lose words go to Python, and only those that do come back.
    own = F.when(is_copy | F.col("_found").isNotNull(), text)
    clean = joined.select("_doc", cleaned(own, F.col("_found"), is_copy).alias("_clean"))
    text = F.when(F.col("_clean.removed_words").isNotNull(), F.col("_clean.text")).otherwise(text)
    return clean.select(*unpacked(docs, text=text), F.col("_clean.removed_words").alias(count))


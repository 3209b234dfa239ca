"""Removal of repeated passages through column-wise suffix sorting of many documents.

A byte goes if a string of ``LENGTH`` bytes around it also starts earlier. Finding such
strings needs the order and the common prefixes of all suffixes. They are built column by
column: in each round every document of a collection gets one more symbol in front, the
collection's Burrows-Wheeler transform grows by these symbols, and the order of the suffixes
and their longest common prefixes are updated from those of the round before. Columns are
read from, and transform and common prefixes written to, external files front to back.

One collection for a whole corpus would make one task, and as many rounds as the longest text
has bytes. So the work is cut along the content:

1. Every window of ``LENGTH`` bytes has an anchor, the smallest hash of a ``GRAM``-byte piece
   in it. Equal windows have equal anchors at equal places, so windows that follow each other
   with the same anchor form one short string, and the column of a byte is its distance from
   the anchor. Equal windows can only begin in the same column.
2. Anchors that occur once in the corpus cannot lead to equal windows. Only strings whose
   anchor repeats go on; a task first joins its own equal anchors, so a frequent one sends a
   row per task.
3. The strings of an anchor meet in one collection. Equal strings of a task are sent once,
   their first occurrence; for the others all windows are known to start earlier. Anchors
   with very many strings are dealt out window by window, by content.
4. The transform of a collection is kept by column (a symbol is the pair of column and byte),
   so a round only appends to it. Suffixes that follow each other with a common prefix of
   ``LENGTH`` or more begin with equal windows; all but the earliest are repeats.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlake.llm import bytesets as bs
from recordlake.llm.store import forget_shuffles, release, stored

LENGTH = 100
GRAM = 32
SHARD_ANCHORS = 400_000
COLLECTION_BYTES = 6 << 20
FLUSH_ANCHORS = 600_000
FLUSH_BYTES = 12 << 20
# An anchor with so many candidate strings is dealt out window by window.
HOT_STRINGS = 200_000
SEGMENT = 1 << 18
_PLACE = np.uint64((1 << 24) - 1)
_NO_ID = -(2**63)
ANCHOR = np.dtype([("h", "<u8"), ("p", "<u4"), ("before", "u1"), ("more", "u1")])
SPAN = np.dtype([("start", "<u4"), ("end", "<u4")])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with the same anchor: text, first window, windows after it, bytes from
    the first window to the anchor, and the anchor's hash. Places count from the text's start."""
    if len(data) > 2 * SEGMENT:
        # One very long text: overlapping segments; an anchor depends on its window alone.
        parts = []
        for at in range(0, len(data) - length + 1, SEGMENT):
            piece = data[at : at + SEGMENT + length - 1]
            row, first, more, before, h = anchors(piece, np.array([0, len(piece)]), length, gram)
            parts.append((row, first + at, more, before, h))
        return tuple(np.concatenate(x) for x in zip(*parts))
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    power, inverse = bs.powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(bs.BYTE_CODES[data] * power[:-1], out=sums[1:])
    h = bs.mix((sums[gram:] - sums[:-gram]) * inverse[: len(data) - gram + 1])
    # Hash above, place below: the minimum is the leftmost smallest hash.
    low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    width, span = length - gram + 1, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if width > span:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    place = (low & _PLACE).astype(np.int64)
    inside = np.zeros(len(place) + 1, np.int32)
    fits = np.diff(offsets) >= length
    np.add.at(inside, offsets[:-1][fits], 1)
    np.add.at(inside, offsets[1:][fits] - length + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    change = np.ones(len(place), bool)
    change[1:] = (place[1:] != place[:-1]) | ~inside[:-1]
    first = np.flatnonzero(inside & change)
    stop = np.ones(len(place), bool)
    stop[:-1] = change[1:] | ~inside[1:]
    last = np.flatnonzero(inside & stop)
    row = np.searchsorted(offsets, first, "right") - 1
    return row, first - offsets[row], last - first, place[first] - first, h[place[first]]


def suffix_repeats(columns, count: int, low: np.ndarray, high: np.ndarray, length: int, width: int, files=None):
    """For strings in order of their first occurrence: which windows also start earlier.

    ``columns(j)`` gives column j of all strings; string i has bytes in columns low[i] to
    high[i] - 1. Returns a matrix strings x first columns. ``files`` may be a pair of open
    binary files that receive the transform and the common prefixes, column by column.
    """
    starts = width - length + 1
    repeated = np.zeros((count, starts), bool)
    order = np.arange(count)
    # Column before which a suffix and the one above it in the order are equal.
    equal_to = np.full(count, width, np.uint8 if width < 256 else np.int32)
    if count:
        equal_to[0] = 0
    for j in range(width - 1, -1, -1):
        symbols = columns(j)[order]
        if files:
            files[0].write(symbols.tobytes())
        moved = np.argsort(symbols, kind="stable")
        new = np.full(count, j, equal_to.dtype)
        a, b = moved[:-1], moved[1:]
        same = np.flatnonzero(symbols[a] == symbols[b])
        new[same + 1] = _range_minimum(equal_to, a[same] + 1, b[same])
        if count:
            new[0] = 0
        order, equal_to = order[moved], new
        if files:
            files[1].write(new.tobytes())
        if j < starts:
            head = equal_to < j + length
            head[:1] = True
            heads = np.flatnonzero(head)
            whole = (low[order] <= j) & (high[order] >= j + length)
            first = np.minimum.reduceat(np.where(whole, order, count), heads) if count else order
            group = np.cumsum(head) - 1
            repeated[order[whole & (order > first[group])], j] = True
    return repeated


def _range_minimum(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low .. high], both included, for many ranges."""
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(low), values.dtype)
    table = values
    for k in range(int(level.max()) + 1 if len(level) else 0):
        own = np.flatnonzero(level == k)
        if len(own):
            out[own] = np.minimum(table[low[own]], table[high[own] - (1 << k) + 1])
        table = np.minimum(table[: len(table) - (1 << k)], table[1 << k :]) if len(table) > 1 << k else table
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of every run of true values in a matrix."""
    edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def _packed(batches: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batches), types)], names)


def _join_binary(column) -> bytes:
    return b"".join(column.to_pylist())


def _by_document(ids, copies, records) -> pa.Table:
    """One row per document with its records as one binary value."""
    order = np.lexsort((copies, ids))
    ids, copies, records = ids[order], copies[order], records[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (copies[1:] != copies[:-1])
    at = np.flatnonzero(new)
    ends = np.append(at, len(ids)) * records.dtype.itemsize
    packed = pa.Array.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(records.tobytes())]
    )
    return pa.table({"id": pa.array(ids[at]), "copy": pa.array(copies[at]), "records": packed.cast(pa.binary())})


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with _id and _copy, which order the documents.

    A null id comes first. Rows that repeat an id are documents of their own, ordered by
    text; only then they are numbered, which moves the texts.
    """
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    repeats = docs.groupBy(ident.alias("_id")).count().where("count > 1")
    rows = docs.withColumn("_id", ident)
    if repeats.isEmpty():
        return rows.withColumn("_copy", F.lit(0))
    return rows.withColumn("_copy", F.row_number().over(Window.partitionBy("_id").orderBy("text")))


def repeated_anchors(rows: DataFrame, shards: int, length: int, gram: int) -> DataFrame:
    """(id, copy, h, place): the runs of every document whose anchor occurs more than once.

    ``h`` is the anchor's hash; ``place`` holds its position, the bytes from the first window
    to it, and the windows after the first (32, 8 and 8 bits).
    """

    def find(batches):
        held, size = [], 0
        for batch in batches:
            ids, copies = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, end, data, offsets in bs.chunks(batch.column(2)):
                doc, first, more, before, h = anchors(data, offsets, length, gram)
                held.append((h, ids[row:end][doc], copies[row:end][doc], first + before, before, more))
                size += len(h)
                if size >= FLUSH_ANCHORS:
                    yield from flush(held)
                    held, size = [], 0
        if size:
            yield from flush(held)

    def flush(held):
        h, ids, copies, p, before, more = (np.concatenate(x) for x in zip(*held))
        records = np.empty(len(h), ANCHOR)
        records["h"], records["p"], records["before"], records["more"] = h, p, before, more
        order = np.argsort(h, kind="stable")
        new = np.ones(len(h), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        times = np.diff(np.append(np.flatnonzero(new), len(h)))
        sent = np.zeros(len(h), bool)  # one occurrence of each anchor goes to its shard
        sent[order[new]] = True
        local = np.zeros(len(h), bool)  # repeated within this task: known already
        local[order] = np.repeat(times > 1, times)
        out = []
        shard = (h % np.uint64(shards)).astype(np.int64)
        for mine, kind, deal in ((sent, 0, shard), (local, 1, None)):
            at = np.flatnonzero(mine)
            # Known ones only pass through: dealt out evenly, in runs of neighbours.
            to = deal[at] if deal is not None else (np.arange(len(at)) // 20_000 + int(h[0] % np.uint64(997))) % shards
            at = at[np.argsort(to, kind="stable")]
            to = np.sort(to)
            for cut in np.split(np.arange(len(at)), np.flatnonzero(np.diff(to)) + 1) if len(at) else []:
                own = at[cut]
                out.append((
                    int(to[cut[0]]), kind, ids[own].tobytes(), copies[own].astype(np.int32).tobytes(),
                    records[own].tobytes(), local[own].tobytes(),
                ))
        if out:
            yield _packed(out, names, [pa.int32(), pa.int32(), *[pa.binary()] * 4])

    names = ["shard", "kind", "ids", "copies", "records", "known"]
    sent = rows.select("_id", "_copy", "text").mapInArrow(
        find, "shard int, kind int, ids binary, copies binary, records binary, known binary"
    )

    def meet(table):
        parts = []
        for kind in (0, 1):
            own = table.filter(pa.array(table["kind"].to_numpy() == kind))
            ids = np.frombuffer(_join_binary(own["ids"]), np.int64)
            copies = np.frombuffer(_join_binary(own["copies"]), np.int32)
            records = np.frombuffer(_join_binary(own["records"]), ANCHOR)
            if kind == 0 and len(ids):
                known = np.frombuffer(_join_binary(own["known"]), bool)
                _, which, times = np.unique(records["h"], return_inverse=True, return_counts=True)
                keep = (times[which] > 1) & ~known
                ids, copies, records = ids[keep], copies[keep], records[keep]
            parts.append((ids, copies, records))
        ids, copies, records = (np.concatenate(x) for x in zip(*parts))
        place = records["p"].astype(np.int64) | records["before"].astype(np.int64) << 32 | records["more"].astype(np.int64) << 40
        return pa.table({
            "id": pa.array(ids), "copy": pa.array(copies), "h": pa.array(records["h"].astype(np.uint64).view(np.int64)),
            "place": pa.array(place),
        })

    return sent.groupBy("shard").applyInArrow(meet, "id long, copy int, h long, place long")


def hot_anchors(found: DataFrame, limit: int) -> set[int]:
    """Hashes of the anchors with ``limit`` or more strings.

    There are at most strings / limit of them, whatever the corpus holds.
    """
    counted = found.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= limit)
    return {r["h"] for r in counted.select("h").collect()}


def repeated_spans(rows: DataFrame, found: DataFrame, collections: int, length: int, gram: int, hot: set[int]) -> DataFrame:
    """(id, copy, records): byte spans of every document that also start earlier."""
    width = 2 * length - gram
    lead = length - gram
    sent = rows.sparkSession.sparkContext.broadcast(hot)
    lists = found.groupBy("id", "copy").agg(F.collect_list(F.struct("h", "place")).alias("_records"))
    joined = rows.select("_id", "_copy", "text").join(
        lists, (F.col("_id") == F.col("id")) & (F.col("_copy") == F.col("copy"))
    ).select("_id", "_copy", F.col("text").cast("binary").alias("text"), "_records")

    def cut(batches):
        state = {}, [], 0
        for batch in batches:
            lists = batch.column(3)
            cuts, flat = lists.offsets.to_pylist(), lists.values
            hashes, places = (flat.field(k).to_numpy() for k in ("h", "place"))
            own = zip(*(batch.column(k).to_pylist() for k in range(3)))
            for (doc, copy, text), low, high in zip(own, cuts, cuts[1:]):
                strings, copies, size = state
                for h, place in zip(hashes[low:high].tolist(), places[low:high].tolist()):
                    p, before, more = place & 0xFFFFFFFF, place >> 32 & 0xFF, place >> 40
                    first = p - before
                    if h in sent.value:
                        for k in range(more + 1):
                            piece = text[first + k : first + k + length]
                            to = int.from_bytes(hashlib.blake2b(piece, digest_size=6).digest(), "little")
                            size += add(strings, copies, to, lead - before + k, piece, doc, copy, p)
                    else:
                        size += add(strings, copies, h, lead - before, text[first : first + more + length], doc, copy, p)
                state = strings, copies, size
                if size >= FLUSH_BYTES:
                    yield from flush(strings, copies)
                    state = {}, [], 0
        yield from flush(*state[:2])

    def add(strings, copies, to, low, piece, doc, copy, p):
        key = (low, piece)
        here = (doc, copy, p)
        old = strings.get(key)
        if old is None:
            strings[key] = (*here, to)
            return len(piece) + 60
        if here < old[:3]:  # rows come in any order; the earliest occurrence stands for all
            strings[key] = (*here, to)
            here = old[:3]
        start = here[2] - lead + low
        copies.append((here[0], here[1], start, start + len(piece)))
        return 40

    def flush(strings, copies):
        out, groups = [], {}
        for (low, piece), (doc, copy, p, to) in strings.items():
            groups.setdefault(to % collections, []).append((doc, copy, p, low, piece))
        for to, own in groups.items():
            # Like strings next to each other, for the compression.
            doc, copy, p, low, pieces = zip(*sorted(own, key=lambda x: x[4]))
            places = np.array(p, np.uint32).tobytes()
            lows = np.array(low, np.uint8).tobytes()
            sizes = np.array([len(x) for x in pieces], np.uint8).tobytes()
            out.append((to, 0, np.array(doc, np.int64).tobytes(), np.array(copy, np.int32).tobytes(), places, lows, sizes, pa.compress(b"".join(pieces), "zstd", asbytes=True)))
        if copies:
            doc, copy, start, end = zip(*copies)
            table = _merged(np.array(doc, np.int64), np.array(copy, np.int32), np.array(start, np.int64), np.array(end, np.int64))
            ids, numbers, spans = table
            for at in range(0, len(ids), 20_000):
                to = (int(ids[at]) + at) % collections
                out.append((to, 1, ids[at : at + 20_000].tobytes(), numbers[at : at + 20_000].tobytes(), spans[at : at + 20_000].tobytes(), b"", b"", b""))
        if out:
            yield _packed(out, names, [pa.int32(), pa.int32(), *[pa.binary()] * 6])

    names = ["collection", "kind", "ids", "copies", "places", "lows", "sizes", "bytes"]
    schema = "collection int, kind int, " + ", ".join(f"{n} binary" for n in names[2:])

    def build(table):
        own = table.filter(pa.array(table["kind"].to_numpy() == 0))
        ids = np.frombuffer(_join_binary(own["ids"]), np.int64)
        copies = np.frombuffer(_join_binary(own["copies"]), np.int32)
        p = np.frombuffer(_join_binary(own["places"]), np.uint32).astype(np.int64)
        low = np.frombuffer(_join_binary(own["lows"]), np.uint8).astype(np.int64)
        sizes = np.frombuffer(_join_binary(own["sizes"]), np.uint8).astype(np.int64)
        packed = zip(own["sizes"].to_pylist(), own["bytes"].to_pylist())
        data = np.frombuffer(b"".join(
            pa.decompress(b, int(np.frombuffer(n, np.uint8).sum(dtype=np.int64)), "zstd", asbytes=True) for n, b in packed), np.uint8)
        order = np.lexsort((p, copies, ids))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        n, column = len(ids), np.repeat(low, sizes)
        ids, copies, p, low, high = ids[order], copies[order], p[order], low[order], (low + sizes)[order]
        with tempfile.TemporaryFile() as column_file, tempfile.TemporaryFile() as bwt, tempfile.TemporaryFile() as lcp:
            matrix = np.zeros((width, n), np.uint8)
            starts = np.cumsum(sizes) - sizes
            within = np.arange(len(data)) - np.repeat(starts, sizes)
            matrix[within + column, np.repeat(rank, sizes)] = data
            matrix[::-1].tofile(column_file)  # the last column is read first
            del matrix, within, column, data
            column_file.seek(0)

            def columns(_):
                return np.frombuffer(column_file.read(n), np.uint8)

            repeated = suffix_repeats(columns, n, low, high, length, width, (bwt, lcp))
        row, a, b = _runs(repeated)
        base = p[row] - lead
        found = _merged(ids[row], copies[row], base + a, base + b + length)
        passed = table.filter(pa.array(table["kind"].to_numpy() == 1))
        also = (
            np.frombuffer(_join_binary(passed["ids"]), np.int64), np.frombuffer(_join_binary(passed["copies"]), np.int32),
            np.frombuffer(_join_binary(passed["places"]), SPAN),
        )
        return _by_document(*(np.concatenate(x) for x in zip(found, also)))

    return joined.mapInArrow(cut, schema).groupBy("collection").applyInArrow(build, "id long, copy int, records binary")


def _merged(ids, copies, start, end):
    """Union of spans per document: ids, copies and SPAN records, in order."""
    order = np.lexsort((start, copies, ids))
    ids, copies, start, end = ids[order], copies[order], start[order], end[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (copies[1:] != copies[:-1])
    # Ends so far within the document: documents are lifted above each other.
    lift = (np.cumsum(new) - 1) * (1 << 33)
    reach = np.maximum.accumulate(end + lift) if len(end) else end
    new[1:] |= (start + lift)[1:] > reach[:-1]
    at = np.flatnonzero(new)
    spans = np.empty(len(at), SPAN)
    spans["start"] = start[at]
    if len(at):
        spans["end"] = (reach - lift)[np.append(at[1:], len(ids)) - 1]
    return ids[at], copies[at], spans


def find_repeats(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_strings: int = HOT_STRINGS) -> DataFrame:
    """(id, copy, records) for :func:`keyed` rows: what repeats earlier bytes, as byte spans.

    Spans of one document may overlap; a document may have several rows.
    """
    if not 8 <= gram <= length <= 127:
        raise ValueError("needs 8 <= gram <= length <= 127")
    total = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // (SHARD_ANCHORS * (length - gram + 2) // 2)))
    found = stored(repeated_anchors(rows, shards, length, gram), "anchors")
    forget_shuffles(rows.sparkSession)
    hot = hot_anchors(found, hot_strings)
    collections = max(1, -(-total // COLLECTION_BYTES))
    spans = stored(repeated_spans(rows, found, collections, length, gram, hot), "repeats")
    release(found)
    forget_shuffles(rows.sparkSession)
    return spans


def _cut(text: bytes, lists) -> tuple[bytes, int, int]:
    """Remaining bytes, removed bytes, and maximal removed runs."""
    if not lists:
        return text, 0, 0
    spans = np.frombuffer(b"".join(lists), SPAN)
    zeros = np.zeros(len(spans), np.int64)
    _, _, spans = _merged(zeros, zeros, spans["start"].astype(np.int64), spans["end"].astype(np.int64))
    kept, at, removed = [], 0, 0
    for start, end in spans.tolist():
        kept.append(text[at:start])
        removed += end - start
        at = end
    kept.append(text[at:])
    return b"".join(kept), removed, len(spans)


def _with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    lists = spans.groupBy("id", "copy").agg(F.collect_list("records").alias("_records")).select(
        F.col("id").alias("_sid"), F.col("copy").alias("_scopy"), "_records"
    )
    return rows.join(lists, (F.col("_id") == F.col("_sid")) & (F.col("_copy") == F.col("_scopy")), "left")


def removal_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``.

    A null text is empty. A null id comes before all others; rows that repeat an id are
    documents of their own, ordered by text, so of equal rows one keeps its bytes. Other
    columns are not read; an empty table gives an empty table.
    """
    rows = keyed(docs.select("doc_id", "text"))
    joined = _with_spans(rows, find_repeats(rows, length)).select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), "_records"
    )

    def apply(batches):
        for batch in batches:
            out = []
            for text, lists in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kept, removed, n = _cut(text, lists)
                out.append((len(text), removed, n, hashlib.sha256(kept).hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(apply, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated bytes taken out of text (and n_chars to match, if there).

    Characters of which a part was removed go entirely. Documents of which nothing but white
    space is left by the removal are left out; documents without repeats stay as they are.
    """
    columns = docs.columns
    rows = keyed(docs)
    joined = _with_spans(rows, find_repeats(rows, length)).select(*columns, "_records")
    place = columns.index("text")

    def apply(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                lists = part.column(len(columns)).to_pylist()
                texts, keep = [], []
                for text, own in zip(part.column(place).to_pylist(), lists):
                    if own:
                        text = _cut(text.encode("utf-8"), own)[0].decode("utf-8", "ignore")
                    texts.append(text)
                    keep.append(not own or bool(text.strip()))
                arrays = dict(zip(part.schema.names, part.columns))
                arrays["text"] = pa.array(texts, pa.string())
                if "n_chars" in columns:
                    kind = part.schema.field("n_chars").type
                    arrays["n_chars"] = pa.array(
                        [len(t) if own else old for t, own, old in zip(texts, lists, arrays["n_chars"].to_pylist())], kind
                    )
                yield pa.RecordBatch.from_arrays([arrays[c] for c in columns], columns).filter(pa.array(keep))

    return joined.mapInArrow(apply, docs.schema)

"""Byte strings that occur more than once, by sampled suffixes over difference covers.

A string of ``length`` bytes that starts at two places is removed wherever it
starts. Sorting every suffix is far more work than finding those places, so
suffixes are sampled: ``D`` is a difference cover modulo ``v`` when every
difference modulo ``v`` is one of two members. Of any two places there is
then an offset below ``v`` that brings both onto sampled places, and so two
equal strings of ``length`` bytes hold, at equal offsets, two sampled places
that start with the same ``length - v + 1`` bytes.

The sampled suffixes are named by such prefixes. The names are dealt to tasks
by value, sorted there and compared with their neighbours. A name that stands
once settles its place: nothing starts there. Places of repeated names recurse:
the strings that they leave open are sampled by a denser cover, with longer
prefixes. From the second cover on a place carries its whole context too, the
bytes that any of its strings can reach; places of one name and one
context settle as repeated. The last cover, modulo 1, holds every place that is
still open and compares whole strings.

Equal texts are taken once (by digest) and are repeats of each other. Of the
places of one name inside one block of texts a task sends one, and tells the
others what that block shows. So a passage that a third of all texts share
costs one entry a block, a group is never paired, and no place is dropped.

Names and contexts are 64-bit hashes each, of every byte of the span with a
shift and multiplication a step; a place settles as repeated on both together.
Texts are told apart by their MD5 digests.

Defined cases: a null or empty text has no bytes; a text shorter than
``length`` keeps all its bytes, and so does one that repeats nothing; a
repeated row repeats its text, whatever its id; null and repeated ids are
carried. Other columns are ignored by ``find_repeats`` and carried by
``remove_repeats``.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightlake.llm.neardup import SIEVE_BITS, id_bitmap
from brightlake.llm.text import chunks, mix64
from brightlake.session import written

LENGTH = 400
#: Periods of the difference covers, each q * q + q + 1 for a prime q, and 1.
COVERS = (183, 31, 1)
#: Sampled places that a task sorts at a time, and that one block of texts sends.
PART_PLACES = 1_000_000
BLOCK_PLACES = 1_000_000

_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_ENTRY = "part int, names binary, contexts binary, places binary, counts binary, keys binary, " \
         "many binary, many_contexts binary"


@lru_cache
def difference_cover(v: int) -> tuple[int, ...]:
    """A perfect difference set modulo ``v = q * q + q + 1``: the powers of a cubic field
    element over the field of ``q`` that lie in one plane."""
    if v == 1:
        return (0,)
    if v == 3:
        return (0, 1)
    q = next(q for q in range(2, v) if q * q + q + 1 == v)
    for rule in range(q ** 3):
        a, b, c = rule % q, rule // q % q, rule // q // q
        x, found = (1, 0, 0), []
        for k in range(v):
            if not x[2]:
                found.append(k)
            x = (x[2] * c % q, (x[0] + x[2] * b) % q, (x[1] + x[2] * a) % q)
        if len(found) == q + 1 and len({(i - j) % v for i in found for j in found}) == v:
            return tuple(found)
    raise ValueError(f"no difference cover modulo {v}")


def span_hashes(data: np.ndarray, at: np.ndarray, n: int, seed: int) -> np.ndarray:
    """64-bit hash of the ``n`` bytes from each place; ``data`` has eight bytes to spare."""
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    h = np.full(len(at), n * 2 + seed, dtype=np.uint64)
    last = n % 8
    for k in range(0, n - last, 8):
        h = (h ^ words[at + k]) * _ODD[seed]
        h ^= h >> np.uint64(29)
    if last:
        h = (h ^ (words[at + (n - last)] & np.uint64((1 << 8 * last) - 1))) * _ODD[seed]
    return mix64(h)


def sampled(lo: np.ndarray, hi: np.ndarray, origin: np.ndarray, v: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the cover in the ranges ``[lo, hi)``, and the range of each; residues count
    from ``origin``, the start of the range's text."""
    cover = np.array(difference_cover(v))
    first = (lo - origin) // v
    blocks = np.maximum(-(-(hi - origin) // v) - first, 0)
    which = np.repeat(np.arange(len(lo)), blocks)
    block = np.arange(len(which)) - np.repeat(np.cumsum(blocks) - blocks, blocks) + first[which]
    at = ((origin[which] + block * v)[:, None] + cover).ravel()
    which = np.repeat(which, len(cover))
    keep = (at >= lo[which]) & (at < hi[which])
    return at[keep], which[keep]


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges of the union of ``[lo, hi)``, ascending."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], hi[order]
    full = hi > lo
    lo, hi = lo[full], hi[full]
    reach = np.maximum.accumulate(hi) if len(hi) else hi
    new = np.ones(len(lo), dtype=bool)
    new[1:] = lo[1:] > reach[:-1]
    return lo[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(lo) - 1]] if len(lo) else hi


def _unpack(value: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(value or b"", np.int32).reshape(-1, 2).astype(np.int64)
    return pairs[:, 0], pairs[:, 1]


def _pack(lo: np.ndarray, hi: np.ndarray) -> bytes:
    return np.stack([lo, hi], axis=1).astype(np.int32).tobytes()


class _Block:
    """Sampled places of some texts: names, contexts, texts and places in the text."""

    def __init__(self):
        self.parts, self.keys, self.size = [], [], 0

    def add(self, names, contexts, texts, places, keys):
        self.parts.append((names, contexts, texts + len(self.keys), places))
        self.keys += keys
        self.size += len(names)

    def entries(self, n_parts: int, last: bool):
        """Rows to send: single names by part, one entry of each other name, told places by key."""
        names, contexts, texts, places = (np.concatenate(x) for x in zip(*self.parts))
        keys = np.array(self.keys, dtype="V16")
        context = contexts.__getitem__ if len(contexts) else lambda _: contexts   # none: first cover
        order = np.lexsort((contexts, names)) if last else np.argsort(names, kind="stable")
        first = np.ones(len(order), dtype=bool)
        first[1:] = names[order[1:]] != names[order[:-1]]
        if last:
            first[1:] |= contexts[order[1:]] != contexts[order[:-1]]
        group = np.cumsum(first) - 1
        lone = np.bincount(group, minlength=1)[group] == 1
        single, told = np.sort(order[lone]), np.sort(order[~lone])
        many = order[first & ~lone]
        send, send_many = ((names[x] % np.uint64(n_parts)).astype(np.int64) for x in (single, many))
        by_part, many_by_part = np.argsort(send, kind="stable"), np.argsort(send_many, kind="stable")
        edges = np.searchsorted(send[by_part], np.arange(n_parts + 1))
        many_edges = np.searchsorted(send_many[many_by_part], np.arange(n_parts + 1))
        for part in range(n_parts):
            at = single[by_part[edges[part]:edges[part + 1]]]
            more = many[many_by_part[many_edges[part]:many_edges[part + 1]]]
            if len(at) or len(more):
                yield part, names[at], context(at), *_by_key(texts[at], places[at], keys), \
                    names[more], contexts[more] if last else contexts[:0]
        if len(told):
            home = keys.view("<u8").reshape(-1, 2)[:, 0][texts[told]] % np.uint64(n_parts)
            for part in np.unique(home):
                at = told[home == part]
                yield n_parts + int(part), names[:0], contexts[:0], \
                    *_by_key(texts[at], places[at], keys), names[:0], contexts[:0]


def _by_key(texts, places, keys):
    """Places with the number of them of each text, and the texts' keys; texts ascend."""
    at = np.flatnonzero(np.r_[True, texts[1:] != texts[:-1]]) if len(texts) else texts
    counts = np.diff(np.r_[at, len(texts)])
    return places.astype(np.int32), counts.astype(np.int32), keys[texts[at]]


def _batch(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()),
         *[pa.array([x.tobytes() for x in c], pa.binary()) for c in columns[1:]]],
        [f.split()[0] for f in _ENTRY.split(", ")])


def _sample(texts: DataFrame, v: int, length: int, n_parts: int, whole: bool) -> DataFrame:
    """Entries of the sampled places of ``_key, _text`` (whole texts) or ``_key, _text, _open``."""
    core, last = length - v + 1, v == 1

    def run(batches):
        block, seen = _Block(), set()
        for batch in batches:
            for first, end, chunk in chunks(batch.column(1), limit=1 << 22):
                keys = batch.column(0).slice(first, end - first).to_pylist()
                start, stop = chunk.offsets[:-1], chunk.offsets[1:]
                if whole:
                    fresh = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
                    row = np.array(fresh, dtype=np.int64)
                    lo, hi = start[row], stop[row] - core + 1
                else:
                    row, lo, hi = _reach(batch.column(2).slice(first, end - first), start, v)
                at, which = sampled(lo, hi, start[row], v)
                if not len(at):
                    continue
                text = row[which]
                data = np.concatenate([chunk.data, np.zeros(8, np.uint8)])
                names = span_hashes(data, at, core, 0)
                contexts = names[:0] if whole and not last else _contexts(
                    data, at, start[text], stop[text], v, length, keys, text)
                block.add(names, contexts, text, at - start[text], keys)
                if block.size >= BLOCK_PLACES:
                    yield _batch(list(block.entries(n_parts, last)))
                    block = _Block()
        if block.size:
            yield _batch(list(block.entries(n_parts, last)))

    return texts.mapInArrow(run, _ENTRY)


def _reach(opened: pa.Array, start: np.ndarray, v: int):
    """Ranges of the places that any open string can sample: text, start and end in the chunk."""
    rows, los, his = [], [], []
    for i, value in enumerate(opened.to_pylist()):
        lo, hi = _unpack(value)
        lo, hi = merged(lo, hi + v - 1)
        rows.append(np.full(len(lo), i))
        los.append(lo + start[i])
        his.append(hi + start[i])
    return tuple(np.concatenate(x).astype(np.int64) for x in (rows, los, his))


def _contexts(data, at, start, stop, v, length, keys, text):
    """Hash of all bytes that a string with this sampled place can reach. Near a text's edge
    the context stands for itself alone, so that it settles nothing."""
    left = v - 1
    inside = (at - left >= start) & (at + length <= stop)
    out = np.zeros(len(at), dtype=np.uint64)
    out[inside] = span_hashes(data, at[inside] - left, left + length, 1)
    own = np.frombuffer(b"".join(k[:8] for k in keys), "<u8")
    edge = np.flatnonzero(~inside)
    out[edge] = mix64(own[text[edge]] + (at[edge] - start[edge]).astype(np.uint64) * _ODD[1])
    return out


def _gathered(rows: DataFrame, n_parts: int, columns: str, fold) -> DataFrame:
    """``fold`` over the packed rows of one part at a time, a part a task."""
    def run(batches):
        held, part = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    yield from fold(held, part) if held else ()
                    held, part = [], row["part"]
                held.append(row)
        if held:
            yield from fold(held, part)

    return rows.repartition(n_parts, "part").sortWithinPartitions("part").mapInArrow(run, columns)


def _column(held: list, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in held), kind)


def _texts_in(held: list) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of some packed rows, and the number of the key of each place."""
    keys, number = np.unique(_column(held, "keys", "<u8").reshape(-1, 2), axis=0, return_inverse=True)
    return keys, np.repeat(number.ravel(), _column(held, "counts", np.int32))


def _judge(entries: DataFrame, n_parts: int, mode: str) -> DataFrame:
    """``_key``, places left open, places settled as repeated: by neighbours in name order.

    Answers are packed again by text, so that the rows follow the texts and not the parts.
    """
    def judged(held: list, part: int):
        keys, texts = _texts_in(held)
        places = _column(held, "places", np.int32)
        if part >= n_parts:
            state = np.full(len(places), 2 if mode == "last" else 1)
        else:
            state = neighbours(*(_column(held, f, np.uint64) for f in ("names", "contexts")), texts, places,
                               *(_column(held, f, np.uint64) for f in ("many", "many_contexts")), mode)
        home = (keys[:, 0] % np.uint64(n_parts)).astype(np.int64)[texts]
        order = np.lexsort((places, texts, home))
        order = order[state[order] > 0]
        texts, places, state, home = texts[order], places[order], state[order], home[order]
        if not len(order):
            return
        edges = np.flatnonzero(np.r_[True, home[1:] != home[:-1]])
        rows = [(home[a], *_by_key(texts[a:b], places[a:b], keys), state[a:b].astype(np.int8))
                for a, b in zip(edges, np.r_[edges[1:], len(home)])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()),
             *[pa.array([r[i].tobytes() for r in rows], pa.binary()) for i in range(1, 5)]],
            ["part", "places", "counts", "keys", "states"])

    def answered(held: list, part: int):
        keys, texts = _texts_in(held)
        places, state = _column(held, "places", np.int32), _column(held, "states", np.int8)
        order = np.lexsort((places, texts))
        texts, places, state = texts[order], places[order], state[order]
        fresh = np.ones(len(order), dtype=bool)   # copies of a text tell the same place twice
        fresh[1:] = (texts[1:] != texts[:-1]) | (places[1:] != places[:-1])
        texts, places, state = texts[fresh], places[fresh], state[fresh]
        edges = np.r_[np.flatnonzero(np.r_[True, texts[1:] != texts[:-1]]), len(texts)]
        columns = [[k.tobytes() for k in keys]]
        for value in (1, 2):
            columns.append([places[a:b][state[a:b] == value].tobytes()
                            for a, b in zip(edges[:-1], edges[1:])])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns],
                                         ["_key", "_opened", "_settled"])

    answers = _gathered(entries, 2 * n_parts, "part int, places binary, counts binary, keys binary, "
                                              "states binary", judged)
    return _gathered(answers, n_parts, "_key binary, _opened binary, _settled binary", answered)


def neighbours(names, contexts, texts, places, many, many_contexts, mode):
    """State of each place: 0 stands once, 1 open, 2 repeated."""
    n = len(names)
    contexts = contexts if len(contexts) else np.zeros(n, np.uint64)
    all_names = np.concatenate([names, many])
    all_contexts = np.concatenate([contexts, many_contexts if len(many_contexts)
                                   else np.zeros(len(many), np.uint64)])
    all_texts = np.concatenate([texts, np.full(len(many), -1)])
    all_places = np.concatenate([places, np.arange(len(many))])
    order = np.lexsort((all_places, all_texts, all_contexts, all_names))
    a, c, t, p = (x[order] for x in (all_names, all_contexts, all_texts, all_places))
    new_name = np.r_[True, a[1:] != a[:-1]]
    new_context = new_name | np.r_[True, c[1:] != c[:-1]]
    new_place = new_context | np.r_[True, (t[1:] != t[:-1]) | (p[1:] != p[:-1])]
    group = np.cumsum(new_context if mode == "last" else new_name) - 1
    weight = np.where(t < 0, 2, new_place.astype(np.int64))
    total = np.bincount(group, weights=weight)
    state_of = (total >= 2).astype(np.int64) * (2 if mode == "last" else 1)
    if mode == "cover":
        plain = np.bincount(group, weights=new_context) == 1
        plain &= np.bincount(group, weights=t < 0) == 0
        state_of = np.where((total >= 2) & plain, 2, state_of)
    state = np.zeros(len(order), dtype=np.int64)
    state[order] = state_of[group]
    return state[:n]


def _apply(asked: DataFrame, v: int, length: int) -> DataFrame:
    """The next state of each text: ranges of string starts that are open, and that are repeated."""
    def run(batches):
        for batch in batches:
            size = [len(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            opens, dones = [], []
            for n, was, done, opened, settled in zip(size, *(batch.column(i).to_pylist()
                                                             for i in (2, 3, 4, 5))):
                end = n - length + 1
                at, sure = (np.frombuffer(x or b"", np.int32).astype(np.int64)
                            for x in (opened, settled))
                lo, hi = merged(np.maximum(at - v + 1, 0), np.minimum(at + 1, end))
                lo, hi = _common(lo, hi, *((np.zeros(1, np.int64), np.array([end]))
                                           if was is None else _unpack(was)))
                opens.append(_pack(lo, hi))
                low, high = _unpack(done)
                dones.append(_pack(*merged(np.r_[low, np.maximum(sure - v + 1, 0)],
                                           np.r_[high, np.minimum(sure + 1, end)])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(opens, pa.binary()),
                 pa.array(dones, pa.binary())], ["_key", "_text", "_open", "_done"])

    return asked.select("_key", "_text", "_open", "_done", "_opened", "_settled").mapInArrow(
        run, "_key binary, _text string, _open binary, _done binary")


def _common(lo, hi, low, high):
    """Common parts of two lists of ascending, separate ranges."""
    if not len(lo) or not len(low):
        return lo[:0], hi[:0]
    edge = np.unique(np.concatenate([lo, hi, low, high]))
    a, b = edge[:-1], edge[1:]
    inside = np.ones(len(a), dtype=bool)
    for x, y in ((lo, hi), (low, high)):
        k = np.searchsorted(x, a, side="right") - 1
        inside &= (k >= 0) & (a < y[np.maximum(k, 0)])
    return merged(a[inside], b[inside])


def _texts_of(texts: DataFrame, answers: DataFrame) -> DataFrame:
    """One row of each text that has an answer. A bitmap of fixed size keeps most others out
    of the shuffle; a task passes a repeated text on once."""
    bits = texts.sparkSession.sparkContext.broadcast(id_bitmap(answers.select("_key").distinct()))

    def sieve(batches):
        seen = set()
        for batch in batches:
            slots = batch.column(2).to_numpy()
            keep = ((bits.value[slots >> 3] >> (7 - (slots & 7))) & 1).astype(bool)
            for i in np.flatnonzero(keep):
                key = batch.column(0)[int(i)].as_py()
                keep[i] = not (key in seen or seen.add(key))
            yield batch.select(["_key", "_text"]).filter(pa.array(keep))

    slot = F.pmod(F.xxhash64("_key"), F.lit(1 << SIEVE_BITS)).cast("int")
    return (texts.select("_key", "_text", slot.alias("_slot"))
            .mapInArrow(sieve, "_key binary, _text string"))


def _found(texts: DataFrame, total: int, length: int, covers) -> DataFrame:
    """``_key``, ``spans`` and ``kept`` bytes of the texts with a repeat; ``texts`` are long enough."""
    state = None
    for v in covers:
        mode = "last" if v == 1 else "filter" if state is None else "cover"
        rate = len(difference_cover(v)) / v
        n_parts = max(1, int(total * rate) // PART_PLACES + 1)
        entries = _sample(texts if state is None else state.select("_key", "_text", "_open"),
                          v, length, n_parts, state is None)
        answers = written(_judge(entries, n_parts, mode), "repeats-answers")
        if state is None:
            asked = (_texts_of(texts, answers).join(answers, "_key").dropDuplicates(["_key"])
                     .withColumn("_open", F.lit(None).cast("binary"))
                     .withColumn("_done", F.lit(None).cast("binary")))
        else:
            asked = state.join(answers, "_key", "left")
        state = written(_apply(asked, v, length), "repeats-state")
        total = _open_places(state, v)
    return written(_spans(state, length), "repeats-found")


def _open_places(state: DataFrame, v: int) -> int:
    """Number of string starts that are open, with the room that their samples reach."""
    def run(batches):
        n = 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                lo, hi = _unpack(value)
                n += int((hi - lo).sum()) + v * len(lo)
        yield pa.RecordBatch.from_pydict({"n": [n]})

    return state.select("_open").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def _spans(state: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            keys, spans, kept = [], [], []
            for key, text, done in zip(batch.column(0).to_pylist(),
                                       batch.column(1).cast(pa.binary()).to_pylist(),
                                       batch.column(2).to_pylist()):
                lo, hi = _unpack(done)
                lo, hi = merged(lo, hi + length - 1)
                if len(lo):
                    keys.append(key)
                    spans.append([{"start": int(a), "end": int(b)} for a, b in zip(lo, hi)])
                    kept.append(b"".join(text[a:b] for a, b in zip(np.r_[0, hi], np.r_[lo, len(text)])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array(kept, pa.binary())], ["_key", "spans", "kept"])

    return state.select("_key", "_text", "_done").mapInArrow(
        run, "_key binary, spans array<struct<start:int,end:int>>, kept binary")


def _keyed(docs: DataFrame, text: str) -> tuple:
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return raw, F.unhex(F.md5(raw))


def _repeats_of(docs: DataFrame, text: str, length: int, covers) -> tuple[DataFrame, DataFrame]:
    """Texts that stand more than once (``_key``), and what the others repeat (``_key, spans, kept``)."""
    raw, digest = _keyed(docs, text)
    texts = docs.select(digest.alias("_key"), F.col(text).alias("_text")).filter(
        F.octet_length(raw) >= length)
    sizes = written(docs.select(digest.alias("_key"), F.octet_length(raw).alias("_size"))
                    .filter(F.col("_size") >= length)
                    .groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"), F.first("_size").alias("_size")),
                    "repeats-texts")
    total = sizes.agg(F.sum("_size")).first()[0] or 0
    return sizes.filter("_rows > 1").select("_key"), _found(texts, total, length, covers)


def find_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                 covers=COVERS) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``spans`` (start and end bytes, none: empty) and
    ``kept_sha256`` of every document."""
    copies, found = _repeats_of(docs, text, length, covers)
    raw, digest = _keyed(docs, text)
    slim = docs.select(F.col(key).alias("_id"), digest.alias("_key"),
                       F.octet_length(raw).alias("n_bytes"), F.sha2(raw, 256).alias("_sha"))
    known = (found.select("_key", "spans", F.sha2("kept", 256).alias("_kept"))
             .join(copies.withColumn("_copied", F.lit(True)), "_key", "full_outer"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").alias("end")))
    spans = (F.when(F.col("_copied"), whole)
             .otherwise(F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))))
    return (slim.join(known, "_key", "left").withColumn("spans", spans)
            .select(F.col("_id").alias(key), F.col("n_bytes").cast("long").alias("n_bytes"),
                    F.aggregate("spans", F.lit(0).cast("long"),
                                lambda n, s: n + s["end"] - s["start"]).alias("n_removed"), "spans",
                    F.when(F.col("_copied"), F.sha2(F.lit(b""), 256))
                    .otherwise(F.coalesce("_kept", "_sha")).alias("kept_sha256")))


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, covers=COVERS,
                   column: str = "kept_bytes") -> DataFrame:
    """``docs`` with the remaining bytes of every text as the binary ``column``."""
    copies, found = _repeats_of(docs, text, length, covers)
    raw, digest = _keyed(docs, text)
    known = (found.select("_key", "kept")
             .join(copies.withColumn("_copied", F.lit(True)), "_key", "full_outer"))
    rows = docs.select(digest.alias("_key"), raw.alias("_raw"),
                       F.struct(*[docs[c] for c in docs.columns]).alias("_doc"))
    kept = F.when(F.col("_copied"), F.lit(b"")).otherwise(F.coalesce("kept", "_raw"))
    return rows.join(known, "_key", "left").select("_doc.*", kept.alias(column))

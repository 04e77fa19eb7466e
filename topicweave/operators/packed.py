"""Documents packed for sampling: one row a document, with the numbers of its words, their copies and the topics of all copies as arrays.

Documents are dealt into buckets by a hash of their id, words into shards by a hash of their text. A bucket also has one row for each shard,
with its words there, their numbers and topic counts inside the bucket; these rows, not the documents, are what is summed and looked up
over the corpus, and only they hold text. Buckets and shards are small enough for one task's memory; draws and sums are array operations.
Long arrays travel as bytes, which Spark moves as a whole instead of number by number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from topicweave.functions.digests import md5_heads

#: Rows of documents have no ``word``; rows of words have no ``doc_id``. ``number`` are the places ``at`` of the document's words in the
#: bucket as bytes of 32-bit integers, ``n`` their copies and ``z`` the topics of all copies as bytes of integers that are, in a bucket, all
#: as wide as the largest one needs; ``counts`` are topic counts of the document. ``word`` is a table ``WORDS`` of the bucket's words in one shard.
SCHEMA = "chain int, bucket int, doc_id long, y int, number binary, n binary, z binary, counts array<long>, shard int, word binary"
ARROW = pa.schema([
    ("chain", pa.int32()), ("bucket", pa.int32()), ("doc_id", pa.int64()), ("y", pa.int32()), ("number", pa.binary()),
    ("n", pa.binary()), ("z", pa.binary()), ("counts", pa.list_(pa.int64())), ("shard", pa.int32()), ("word", pa.binary()),
])
#: Columns of words; ``counts`` has as many numbers as topics, whole ones of 32 bits where these hold them.
WORDS = ("word", "at", "counts", "first")
#: Texts hashed together.
TEXTS = 1 << 17
#: Numbers in an array of weights that are computed together; arrays of a step stay in the processor's cache.
CELLS = 1 << 16


@dataclass(frozen=True)
class Head:
    """A softmax head whose chances weigh the draws; ``eta[c][i]`` is the coefficient of class c and topic i.

    ``label``: topic i is weighed by the chance of the document's own class if the whole block moved to it, documents without a class
    by 1. ``ratio``: by softmax entry i with the block in its document over the entry without it, where an empty rest counts as zero.
    """

    kind: str
    eta: tuple[tuple[float, ...], ...]

    def factors(self, own: np.ndarray, d: np.ndarray, y: np.ndarray) -> np.ndarray:
        """One factor for each row and topic; ``y`` is below 0 where there is no class."""
        eta, length = np.array(self.eta), d.sum(axis=1, keepdims=True).astype(np.float64)
        size = own.sum(axis=1, keepdims=True)
        if self.kind == "ratio":
            rest = length - size
            left = np.where(rest > 0, (d - own) / np.maximum(rest, 1), 0.0)
            inside, outside = (d / length) @ eta.T, left @ eta.T
            shift = np.logaddexp.reduce(outside, axis=1) - np.logaddexp.reduce(inside, axis=1)
            return np.exp(inside - outside + shift[:, None])
        rest = np.exp(((d - own) / length) @ eta.T)
        moved = rest[:, :, None] * np.exp(eta[None] * (size / length)[:, :, None])
        own_class = np.take_along_axis(moved, np.maximum(y, 0)[:, None, None], axis=1)[:, 0]
        return np.where(y[:, None] >= 0, own_class / moved.sum(axis=1), 1.0)


def spans(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def lists(values, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(spans(lengths), pa.int32()), pa.array(values, kind))


def as_bytes(values: np.ndarray, lengths: np.ndarray, kind: str | None = None) -> pa.Array:
    """Rows of so many whole numbers, none below 0, as bytes; all of them as wide as the largest one needs, or of one ``kind``."""
    kind = kind or next(t for t in ("<u1", "<u2", "<u4") if values.max(initial=0) <= np.iinfo(t).max)
    ends = pa.array(int(kind[-1]) * spans(lengths), pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, ends.buffers()[1], pa.py_buffer(np.ascontiguousarray(values, kind))])


def bytes_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows, one after the other, and how many each row has."""
    parts, lengths = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for chunk in column.chunks:
        ends = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset:chunk.offset + len(chunk) + 1] if len(chunk) else np.zeros(1, np.int32)
        lengths.append(np.diff(ends).astype(np.int64))
        if ends[-1] > ends[0]:
            parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[ends[0]:ends[-1]])
    return np.concatenate(parts), np.concatenate(lengths)


def of_bytes(column: pa.ChunkedArray, number: int) -> np.ndarray:
    """The ``number`` whole numbers of all rows of a bucket, one after the other."""
    held = bytes_of(column)[0]
    return held.view(f"<u{len(held) // number}").astype(np.int64) if number else np.zeros(0, np.int64)


def by_topic(counts: np.ndarray) -> np.ndarray:
    """A row for each topic."""
    return np.ascontiguousarray(counts.T, np.float64)


def shares_below(p: np.ndarray) -> np.ndarray:
    """The sum of each column, added up topic by topic."""
    out = p[0].copy()
    for row in p[1:]:
        out += row
    return out


def table_bytes(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def bytes_tables(column: pa.ChunkedArray) -> list[pa.Table]:
    return [pa.ipc.open_stream(row.as_buffer()).read_all() for row in column]


def whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.nulls(0, column.type)


def flat(column: pa.ChunkedArray) -> pa.Array:
    return whole(column).flatten()


class Bucket:
    """Documents of one chain and bucket: their pairs of document and word one after the other, and the copies of all pairs. ``number``
    are the places of the pairs' words in ``words``."""

    def __init__(
        self, doc_ids: pa.Array, y: pa.Array, sizes: np.ndarray, number: np.ndarray, n: np.ndarray, words: pa.Array | None = None,
        z: np.ndarray | None = None, shards: np.ndarray | None = None,
    ):
        self.shards = shards
        self.doc_ids, self.y, self.sizes, self.number, self.n, self.words, self.z = doc_ids, y, sizes, number.astype(np.int64), n, words, z
        self.document = np.repeat(np.arange(len(sizes)), sizes)
        self.pair = np.repeat(np.arange(len(n)), n)

    @classmethod
    def of_pairs(cls, rows: pa.Table) -> "Bucket":
        """From rows ``doc_id, word, n``; rows without id are one document."""
        order = pc.sort_indices(rows["doc_id"])
        coded = whole(rows["word"]).dictionary_encode()
        doc_ids, number, n = (whole(rows["doc_id"]).take(order), coded.indices.take(order), whole(rows["n"]).take(order))
        value, known = pc.fill_null(doc_ids, 0).to_numpy(), pc.is_valid(doc_ids).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (known[1:] != known[:-1])]))
        return cls(
            doc_ids.take(pa.array(begins)), pa.nulls(len(begins), pa.int32()), np.diff(np.append(begins, len(value))),
            number.to_numpy(), n.to_numpy(), coded.dictionary)

    @classmethod
    def of_rows(cls, rows: pa.Table, words: pa.Array | None = None, shards: np.ndarray | None = None) -> "Bucket":
        """From rows of documents; they may lack classes and topics."""
        number, lengths = bytes_of(rows["number"])
        n, own = of_bytes(rows["n"], len(number) // 4), set(rows.column_names)
        y = whole(rows["y"]) if "y" in own else pa.nulls(len(rows), pa.int32())
        z = of_bytes(rows["z"], int(n.sum())) if "z" in own else None
        return cls(whole(rows["doc_id"]), y, lengths // 4, number.view("<i4"), n, words, z, shards)

    def part(self, first: int, last: int) -> "Bucket":
        """The documents from ``first`` to before ``last``."""
        pairs = spans(self.sizes)[[first, last]]
        copies = spans(self.n)[pairs]
        own, blocks = slice(first, last), slice(*pairs)
        return Bucket(self.doc_ids[own], self.y[own], self.sizes[own], self.number[blocks], self.n[blocks], self.words, self.z[slice(*copies)])

    def hashes(self, tag: str) -> np.ndarray:
        """32 bits for each copy: the beginning of the MD5 of ``document|word|copy|tag``."""
        ids, copy = self.doc_ids.cast(pa.string()), np.arange(len(self.pair)) - np.repeat(spans(self.n)[:-1], self.n)
        tails, out = pa.array([f"{rep}|{tag}" for rep in range(1, int(self.n.max(initial=0)) + 1)], pa.string()), [np.zeros(0, np.int64)]
        for at in range(0, len(copy), TEXTS):
            pair = self.pair[at:at + TEXTS]
            parts = ids.take(pa.array(self.document[pair])), self.words.take(pa.array(self.number[pair])), tails.take(pa.array(copy[at:at + TEXTS]))
            out.append(md5_heads(pc.binary_join_element_wise(*parts, "|", null_handling="skip")))
        return np.concatenate(out)

    def uniforms(self, tag: str) -> np.ndarray:
        return (self.hashes(tag) + 0.5) / 4294967296.0

    def lengths(self) -> np.ndarray:
        """Copies of each document."""
        return np.diff(spans(self.n)[spans(self.sizes)])

    def document_counts(self, k: int) -> np.ndarray:
        at = self.document[self.pair] * k + self.z
        return np.bincount(at, minlength=len(self.sizes) * k).reshape(-1, k)

    def word_counts(self, k: int) -> np.ndarray:
        return np.bincount(self.number[self.pair] * k + self.z, minlength=len(self.words) * k).reshape(-1, k)

    def pair_counts(self, k: int) -> np.ndarray:
        return np.bincount(self.pair * k + self.z, minlength=len(self.n) * k).reshape(-1, k)

    def weights(
        self, counts: np.ndarray, totals: np.ndarray, terms: int, model, w: np.ndarray | None = None,
    ) -> Iterator[tuple[slice, slice, np.ndarray, np.ndarray]]:
        """Topic weights of blocks or tokens, some at a time, from the counts with the block or token itself left out.

        ``counts`` are those of the words over the corpus, ``w`` the same by topic. Yields the rows, their copies, the row of each copy, and the weights with a row
        for each topic, which keeps all steps in long loops.
        """
        k, d, y = model.k, np.ascontiguousarray(self.document_counts(model.k).T, np.float64), pc.fill_null(self.y, -1).to_numpy()
        w = by_topic(counts) if w is None else w
        block, begins = model.grain == "block", spans(self.n)
        rows = len(self.n) if block else len(self.z)
        step = max(1, CELLS // (k * (len(model.head.eta) if model.head else 1)))
        for at in range(0, rows, step):
            stop = min(rows, at + step)
            if block:
                pairs, copies = slice(at, stop), slice(begins[at], begins[stop])
                row = self.pair[copies] - at
                own = np.bincount(self.z[copies] * (stop - at) + row, minlength=(stop - at) * k).reshape(k, -1)
            else:
                pairs, copies = self.pair[at:stop], slice(at, stop)
                row = np.arange(stop - at)
                own = self.z[copies] == np.arange(k)[:, None]
            of, number, own, p = self.document[pairs], self.number[pairs], own.astype(np.float64), np.empty((k, stop - at))
            for i in range(k):
                left, right, below = d[i].take(of), w[i].take(number), totals[i] - own[i]
                left -= own[i]
                left += model.alpha
                right -= own[i]
                right += model.beta
                below += model.beta * terms
                left *= right
                np.divide(left, below, out=p[i])
            if model.head:
                p *= model.head.factors(own.T, d[:, of].T, y[of]).T
            yield slice(at, stop), copies, row, p

    def draw(self, counts: np.ndarray, totals: np.ndarray, terms: int, model, sweep: int) -> np.ndarray:
        """New topics of all copies by inverse CDF of the weights before the sweep."""
        u, z = self.uniforms(f"{model.seed}.{sweep}"), np.zeros(len(self.z), np.int64)
        for _, copies, row, p in self.weights(counts, totals, terms, model):
            for i in range(1, model.k):
                p[i] += p[i - 1]
            target = u[copies] * p[-1].take(row)
            for bound in p[:-1]:
                z[copies] += target >= bound.take(row)
        return z

    def mean_weights(self, counts: np.ndarray, totals: np.ndarray, terms: int, model) -> np.ndarray:
        """For each document the mean of its blocks' normalised weights, by their copies."""
        sums = np.zeros((len(self.sizes), model.k))
        for rows, _, _, p in self.weights(counts, totals, terms, model):
            p /= shares_below(p)
            p *= self.n[rows]
            of, begins = np.unique(self.document[rows], return_index=True)
            sums[of] += np.add.reduceat(p, begins, axis=1).T
        return sums / self.lengths()[:, None]

    def probabilities(self, counts: np.ndarray, totals: np.ndarray, terms: int, model) -> Iterator[np.ndarray]:
        """For one document after the other the normalised weights of its blocks."""
        # parts of several documents; their weights are computed in smaller steps
        pairs, first, step, w = spans(self.sizes), 0, max(1, 16 * CELLS // model.k), by_topic(counts)
        while first < len(self.sizes):
            last = max(first + 1, int(np.searchsorted(pairs, pairs[first] + step, "right")) - 1)
            weighted = self.part(first, last).weights(counts, totals, terms, model, w)
            parts = [np.ascontiguousarray(np.divide(p, shares_below(p), out=p).T) for _, _, _, p in weighted]
            yield from np.split(np.concatenate(parts), pairs[first + 1:last] - pairs[first])
            first = last

    def tables(self, chain: int, bucket: int, k: int) -> tuple[pa.Table, pa.Table]:
        """Rows of the documents and, by shard, of the words that they have."""
        documents, d, v = len(self.sizes), self.document_counts(k), self.word_counts(k)
        held = np.flatnonzero(v.any(axis=1) & self.words.is_valid().to_numpy(zero_copy_only=False))
        held = held[np.argsort(self.shards[held], kind="stable")]
        shards, begins = np.unique(self.shards[held], return_index=True)
        terms = words_table(self.words.take(pa.array(held)), held, v[held])
        packs = shard_packs(terms, begins)

        docs = pa.Table.from_arrays([
            fixed(chain, documents), fixed(bucket, documents), self.doc_ids, self.y, as_bytes(self.number, self.sizes, "<i4"),
            as_bytes(self.n, self.sizes), as_bytes(self.z, self.lengths()), lists(d.ravel(), np.full(documents, k), pa.int64()),
            pa.nulls(documents, pa.int32()), pa.nulls(documents, pa.binary()),
        ], schema=ARROW)
        words = pa.Table.from_arrays([
            fixed(chain, len(packs)), fixed(bucket, len(packs)), *(pa.nulls(len(packs), t) for t in ARROW.types[2:8]),
            pa.array(shards, pa.int32()), pa.array(packs, pa.binary()),
        ], schema=ARROW)
        return docs, words


def words_table(words: pa.Array, at: np.ndarray, counts: np.ndarray, first: np.ndarray | None = None) -> pa.Table:
    """``WORDS``."""
    whole_kind = pa.int32() if counts.max(initial=0) <= np.iinfo(np.int32).max else pa.int64()
    kind = pa.float64() if counts.dtype.kind == "f" else whole_kind
    kept = pa.FixedSizeListArray.from_arrays(pa.array(counts.ravel(), kind), counts.shape[1])
    return pa.table([words, pa.array(at, pa.int32()), kept, pa.array(np.zeros(len(at), bool) if first is None else first)], names=list(WORDS))


def shard_packs(words: pa.Table, begins: np.ndarray) -> list[bytes]:
    """A table ``WORDS`` in the order of its shards, packed shard by shard."""
    return [table_bytes(words.slice(begin, end - begin)) for begin, end in zip(begins, np.append(begins, len(words))[1:])]


def joined_words(packs: list[pa.Table]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words, places and counts of several tables ``WORDS``."""
    counts = [flat(pack["counts"]).to_numpy().reshape(pack.num_rows, -1) for pack in packs]
    counts = [part if part.dtype.kind == "f" else part.astype(np.int64) for part in counts]
    rows = pa.concat_tables([pack.select(["word", "at"]) for pack in packs])
    return whole(rows["word"]), rows["at"].to_numpy(), np.concatenate(counts)


def fixed(value: int, n: int) -> pa.Array:
    return pa.array(np.full(n, value), pa.int32())


def names_of(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def empty(schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()} | {
        f"array<{name}>": pa.list_(kind) for name, kind in (("int", pa.int32()), ("long", pa.int64()), ("double", pa.float64()))}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]).empty_table()


def started(rows: pa.Table, models, shards: int, labels: pa.Table | None = None) -> pa.Table:
    """A bucket's rows with hashed first topics, from rows ``chain, bucket, doc_id, word, n``; ``labels`` has classes ``doc_id, y``. A
    document with several of them has a row for each."""
    if not rows.num_rows:
        return ARROW.empty_table()
    chain, bucket = rows["chain"][0].as_py(), rows["bucket"][0].as_py()
    model, made = models[chain], Bucket.of_pairs(rows)
    made.z = made.hashes(str(model.seed)) % model.k
    made.shards = md5_heads(pc.fill_null(made.words, "")) % shards
    docs, terms = made.tables(chain, bucket, model.k)
    if labels is not None:
        places = pa.table([made.doc_ids, pa.array(np.arange(len(docs)))], names=["doc_id", "_at"])
        found = places.join(labels.select(["doc_id", "y"]), "doc_id", join_type="left outer", use_threads=False)
        docs = docs.take(found["_at"]).set_column(3, "y", found["y"].cast(pa.int32()))
    return pa.concat_tables([docs, terms])


def met(docs: pa.Table, words: pa.Table, k: int) -> tuple[Bucket, np.ndarray]:
    """The documents of a bucket, and the counts that come along for its words."""
    packs = bytes_tables(words["word"])
    if not packs:
        return Bucket.of_rows(docs, pa.nulls(0, pa.string()), np.zeros(0, np.int64)), np.zeros((0, k), np.int64)
    texts, at, found = joined_words(packs)
    place, shards = np.full(at.max(initial=-1) + 1, -1), np.zeros(at.max(initial=-1) + 1, np.int64)
    place[at] = np.arange(len(at))
    shards[at] = np.repeat(words["shard"].to_numpy(), [pack.num_rows for pack in packs])
    held = Bucket.of_rows(docs, texts.take(pa.array(place, mask=place < 0)), shards)
    counts = np.zeros((len(place), k), found.dtype)
    counts[at] = found[:, :k]
    return held, counts


#: The words of a bucket in one shard with the corpus counts; ``totals`` and ``terms`` are those of the words that it is the ``first`` to hold.
SUMS = "chain int, bucket int, shard int, word binary, totals array<long>, terms long"
#: The same for counts that aren't whole.
MASSES = SUMS.replace("array<long>", "array<double>")


def summed(words: pa.Table) -> pa.Table:
    """``SUMS`` or ``MASSES`` of a chain's shard, from the rows ``chain, bucket, shard, word`` of all its buckets."""
    words = words.sort_by("bucket")
    packs = bytes_tables(words["word"])
    texts, at, counts = joined_words(packs)
    ends, coded = spans(np.array([pack.num_rows for pack in packs])), texts.dictionary_encode()
    code = coded.indices.to_numpy()
    sums = np.stack([np.bincount(code, column, len(coded.dictionary)) for column in counts.T], axis=1).astype(counts.dtype)
    first = np.zeros(len(code), bool)
    first[np.unique(code, return_index=True)[1]] = True
    own, totals, terms = [], [], []
    for begin, end in zip(ends[:-1], ends[1:]):
        part, new = sums[code[begin:end]], first[begin:end]
        own.append(table_bytes(words_table(texts.slice(begin, end - begin), at[begin:end], part, new)))
        totals.append(part[new].sum(axis=0))
        terms.append(int(new.sum()))
    return pa.table(
        [*(words[name] for name in ("chain", "bucket", "shard")), pa.array(own, pa.binary()),
         lists(np.concatenate(totals), np.full(len(own), sums.shape[1]), pa.from_numpy_dtype(sums.dtype)), pa.array(terms, pa.int64())], names=names_of(SUMS))


#: A row for each word that a bucket holds.
SUM_ROWS = "chain int, bucket int, word string, at int, counts array<long>, first boolean"


def sum_rows(only_first: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads rows ``SUM_ROWS`` off ``SUMS``, a word once only if ``only_first``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chain, bucket, pack in zip(batch.column("chain"), batch.column("bucket"), batch.column("word")):
                rows = pa.ipc.open_stream(pack.as_buffer()).read_all()
                rows = rows.filter(rows["first"]) if only_first else rows
                for at in range(0, rows.num_rows, TEXTS):
                    part = rows.slice(at, TEXTS)
                    keys = [fixed(key.as_py(), part.num_rows) for key in (chain, bucket)]
                    part = part.set_column(2, "counts", part["counts"].cast(pa.list_(pa.int64())))
                    yield pa.table([*keys, *part.columns], names=names_of(SUM_ROWS)).combine_chunks().to_batches()[0]

    return run


def swept(docs: pa.Table, words: pa.Table, models, totals, sweep: int) -> pa.Table:
    """A bucket's rows after a sweep. ``words`` has the corpus counts of the bucket's words, ``totals`` by chain the topic totals
    and the number of terms."""
    if not docs.num_rows:
        return ARROW.empty_table()
    chain, bucket = docs["chain"][0].as_py(), docs["bucket"][0].as_py()
    model = models[chain]
    held, counts = met(docs, words, model.k)
    held.z = held.draw(counts, *totals[chain], model, sweep)
    return pa.concat_tables(held.tables(chain, bucket, model.k))


FEATURES = "chain int, doc_id long, g array<double>"


def featured(docs: pa.Table, words: pa.Table, models, totals) -> pa.Table:
    """``FEATURES``: the mean block probabilities of a bucket's documents."""
    if not docs.num_rows:
        return empty(FEATURES)
    chain = docs["chain"][0].as_py()
    model = models[chain]
    held, counts = met(docs, words, model.k)
    g = held.mean_weights(counts, *totals[chain], model)
    return pa.table([fixed(chain, len(g)), held.doc_ids, lists(g.ravel(), np.full(len(g), model.k), pa.float64())], names=names_of(FEATURES))


WEIGHTS = "chain int, doc_id long, word string, n long, doc_n long, p array<double>"


def weighed(docs: pa.Table, words: pa.Table, models, totals) -> pa.Table:
    """``WEIGHTS``: the topic weights of a bucket's blocks and the copies of their documents."""
    if not docs.num_rows:
        return empty(WEIGHTS)
    chain = docs["chain"][0].as_py()
    model, parts = models[chain], []
    held, counts = met(docs, words, model.k)
    lengths = held.lengths()
    for rows, _, _, p in held.weights(counts, *totals[chain], model):
        of = held.document[rows]
        parts.append(pa.table([
            fixed(chain, len(of)), held.doc_ids.take(pa.array(of)), held.words.take(pa.array(held.number[rows])), pa.array(held.n[rows], pa.int64()),
            pa.array(lengths[of], pa.int64()), lists(p.T.ravel(), np.full(len(of), model.k), pa.float64())], names=names_of(WEIGHTS)))
    return pa.concat_tables(parts)


BLOCKS = "chain int, doc_id long, word string, n long, c array<int>"
TOKENS = "chain int, doc_id long, word string, rep int, z int"


def unpacked(docs: pa.Table, words: pa.Table, models) -> pa.Table:
    """``BLOCKS`` or ``TOKENS`` of a bucket."""
    schema = BLOCKS if models[0].grain == "block" else TOKENS
    if not docs.num_rows:
        return empty(schema)
    chain = docs["chain"][0].as_py()
    k = models[chain].k
    held, _ = met(docs, words, k)
    if schema == BLOCKS:
        pair, columns = np.arange(len(held.n)), [pa.array(held.n, pa.int64()), lists(held.pair_counts(k).ravel(), np.full(len(held.n), k), pa.int32())]
    else:
        copy = np.arange(len(held.z)) - np.repeat(spans(held.n)[:-1], held.n) + 1
        pair, columns = held.pair, [pa.array(copy, pa.int32()), pa.array(held.z, pa.int32())]
    ids, text = held.doc_ids.take(pa.array(held.document[pair])), held.words.take(pa.array(held.number[pair]))
    return pa.table([fixed(chain, len(pair)), ids, text, *columns], names=names_of(schema))


#: A bucket's labelled documents in one row, with the corpus counts of their words; ``times`` tells how often a label came.
BOUND = "y array<int>, times array<int>, sizes array<int>, number array<int>, n array<int>, z array<int>, counts array<long>"


def bound(docs: pa.Table, words: pa.Table, models) -> pa.Table:
    """``BOUND``: all that the block probabilities of a bucket follow from, without text and without the probabilities."""
    if not docs.num_rows:
        return empty(BOUND)
    held, counts = met(docs, words, models[docs["chain"][0].as_py()].k)
    used, number = np.unique(held.number, return_inverse=True)
    values = whole(docs["y"]), whole(docs["times"]), held.sizes, number, held.n, held.z, counts[used].ravel()
    kinds = empty(BOUND).schema.types
    return pa.table([lists(v, np.array([len(v)]), kind.value_type) for v, kind in zip(values, kinds)], names=names_of(BOUND))


def bound_documents(model, totals: np.ndarray, terms: int) -> Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray, np.ndarray]]]:
    """Reads rows ``BOUND``: class, copies and block probabilities of each document."""
    def of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for row in range(batch.num_rows):
            y, times, sizes, number, n, z, counts = (batch.column(name)[row].values.to_numpy() for name in names_of(BOUND))
            held = Bucket(pa.nulls(len(sizes), pa.int64()), pa.array(y), sizes, number, n, z=z)
            ends = np.cumsum(sizes)
            shares = held.probabilities(counts.reshape(-1, model.k), totals, terms, model)
            for c, m, start, end, p in zip(y.tolist(), times.tolist(), ends - sizes, ends, shares):
                yield c, (n[start:end] * m).astype(np.float64), p

    return of

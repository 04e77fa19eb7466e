"""Token ids in flat binary files with 64-bit document offsets.

Documents are range-partitioned by id and sorted; each task encodes its range and writes two files: ``NNNNN.bin``, the ids as
little-endian unsigned integers (16 bits if the vocabulary fits, else 32), and ``NNNNN.idx``, for each document its id and the
offset of its first token in the file as two signed 64-bit integers, with a last pair ``(documents, tokens)``. A manifest
row per file goes to Parquet; prefix sums over the manifest give each file its base in the whole stream. Readers map the
files into memory.

The folder must be a path that all machines mount, since files are mapped (``spark.checkpoint.dir`` by default). A file is
written under a name of its own and renamed when complete; the same rows make the same bytes, so a task that runs again
does no harm. Defined cases: a null text is empty and yields the end id alone; rows without id come first; rows with equal ids
are ordered by a hash of the text; an empty table gives an empty manifest.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicweave.llm.common import slices, whole
from topicweave.llm.pieces import parts
from topicweave.session import scratch_path

NO_ID = -(1 << 63)
MANIFEST = "number long, file string, kind string, documents long, tokens long"
#: Bytes of text that are encoded together.
BATCH = 8 << 20


def mounted(path: str) -> str:
    """The local name of a path on a mounted file system."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"token files are memory-mapped and need a mounted folder, not {path}")
    return url.path


# White space of Unicode and its like; a text with a space that has some on both sides, or before it and the end behind it, is cut by
# ``parts``, all others at every space.
_WHITE = r"[\pZ\x09-\x0D\x1C-\x20\x{85}]"
_AMID_SPACES = rf"{_WHITE} (?:{_WHITE}|\z)"


def ragged(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``begin, begin + 1, ...`` of each range, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(begins - before, lengths)


class PartEncoder:
    """Encodes parts of texts by a tokenizer file. Texts are taken a batch at a time: parts are cut and numbered by array functions, so
    only the different parts of a batch are looked up, and only unknown ones encoded. The ids of known parts stay in one packed array
    beside their texts; when more than ``known`` parts are held, those of the present batch alone stay."""

    def __init__(self, path: str, kind: str, known: int = 2_000_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.kind, self.most = Tokenizer.from_file(path), np.dtype(kind), known
        self.known = pa.array([], pa.large_string())
        self.ids, self.begins = np.zeros(0, self.kind), np.zeros(1, np.int64)

    def _made(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and how many each has."""
        made = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, made), np.int64, len(made))
        return np.fromiter(chain.from_iterable(made), self.kind, int(lengths.sum())), lengths

    def _find(self, different: pa.Array) -> np.ndarray:
        """The places of different parts among the known ones; learns those that are new, which come last. The known ones are looked
        through once."""
        at = pc.index_in(different, value_set=self.known)
        missing = at.is_null().to_numpy(zero_copy_only=False)
        if not missing.any():
            return at.to_numpy()
        new, old = different.filter(pa.array(missing)), at.drop_null().to_numpy()
        places = np.empty(len(different), np.int64)
        places[~missing] = old
        if len(self.known) + len(new) > self.most and len(self.known):
            lengths = np.diff(self.begins)[old]
            self.ids = self.ids[ragged(self.begins[old], lengths)]
            self.known, self.begins = self.known.take(pa.array(old)), np.concatenate([[0], np.cumsum(lengths)])
            places[~missing] = np.arange(len(old))
        places[missing] = len(self.known) + np.arange(len(new))
        ids, lengths = self._made([" " + part for part in new.to_pylist()])
        self.known = pa.concat_arrays([self.known, new])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, ids])
        return places

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, ``end_id`` behind each, and how many each has."""
        texts = texts.cast(pa.large_string())
        odd = np.flatnonzero(pc.match_substring_regex(texts, _AMID_SPACES).to_numpy(zero_copy_only=False))
        cut = pc.split_pattern(texts, " ")
        offsets = cut.offsets.to_numpy()
        begins, counts = offsets[:-1] + 1, np.diff(offsets) - 1
        firsts, flat = cut.values.take(pa.array(offsets[:-1])).to_pylist(), [cut.values]
        behind = len(cut.values)
        for i in odd:
            firsts[i], rest = parts(texts[int(i)].as_py())
            flat.append(pa.array(rest, pa.large_string()))
            begins[i], counts[i], behind = behind, len(rest), behind + len(rest)
        # the entries of each text: its first part, the others, the end
        which = ragged(begins, counts)
        encoded = pa.concat_arrays(flat).take(pa.array(which)).dictionary_encode()
        places = self._find(encoded.dictionary)
        ids, lengths = self._made(firsts)
        pool = np.concatenate([self.ids, ids, np.array([end_id], self.kind)])
        edges = np.concatenate([self.begins, self.begins[-1] + np.cumsum(lengths), [len(pool)]])
        entry = np.empty(len(which) + 2 * len(texts), np.int64)
        starts = np.cumsum(counts + 2) - counts - 2
        entry[starts] = len(self.begins) - 1 + np.arange(len(texts))
        entry[starts + counts + 1] = len(edges) - 2
        entry[ragged(starts + 1, counts)] = places[encoded.indices.to_numpy()]
        sizes = np.diff(edges)[entry]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return pool[ragged(edges[entry], sizes)], total[starts + counts + 2] - total[starts]


@lru_cache(maxsize=2)
def part_encoder(path: str, kind: str) -> PartEncoder:
    return PartEncoder(path, kind)


def write(docs: DataFrame, tokenizer: str, vocabulary_size: int, end_id: int = 0, folder: str | None = None, files: int | None = None) -> DataFrame:
    """Write ``docs (doc_id, text)`` and return the manifest ``number, file, kind, documents, tokens, base, first_document``.

    ``files`` is the number of ranges, by default that of the shuffle partitions.
    """
    spark = docs.sparkSession
    target = folder or scratch_path(spark, "token-files")
    place, kind = mounted(target), "<u2" if vocabulary_size <= 1 << 16 else "<u4"
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        encoder = part_encoder(tokenizer, kind)
        os.makedirs(place, exist_ok=True)
        name, own = f"{place}/{number:05d}", f"{place}/.{number:05d}-{uuid.uuid4().hex}"
        documents = tokens = 0
        with open(own + ".bin", "wb") as ids_file, open(own + ".idx", "wb") as index_file:
            for batch in chain.from_iterable(slices(b, BATCH) for b in batches):
                ids, lengths = encoder.encode(batch.column("text"), end_id)
                offsets = tokens + np.cumsum(lengths) - lengths
                index_file.write(np.stack([batch.column("doc_id").to_numpy(), offsets], 1).astype("<i8").tobytes())
                ids_file.write(ids.tobytes())
                documents, tokens = documents + len(lengths), tokens + len(ids)
            index_file.write(np.array([documents, tokens], "<i8").tobytes())
        for ending in (".bin", ".idx"):
            os.replace(own + ending, name + ending)
        yield pa.RecordBatch.from_pydict(
            {"number": [number], "file": [name], "kind": [kind], "documents": [documents], "tokens": [tokens]})

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), whole().alias("text"))
    ranged = rows.repartitionByRange(files, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    ranged.mapInArrow(run, MANIFEST).write.parquet(f"{target}/manifest")
    return manifest(spark, target)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with each file's base: one row per file, so the sums run over few rows."""
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return rows.where("documents > 0").select(
        "*", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")).alias("base"),
        F.coalesce(F.sum("documents").over(before), F.lit(0).cast("long")).alias("first_document"),
    )


def documents_of(file: str, kind: str) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(doc_id, offset in the file, ids)`` of each document, from the mapped file."""
    index = np.memmap(file + ".idx", "<i8", "r").reshape(-1, 2)
    ids = np.memmap(file + ".bin", kind, "r")
    ends = np.append(index[1:-1, 1], index[-1, 1])
    for (doc_id, start), end in zip(index[:-1], ends):
        yield int(doc_id), int(start), ids[start:end]


def read(files: DataFrame, rows: int = 5_000) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document from the files; a task maps one file at a time."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for file, kind, base in zip(batch["file"], batch["kind"], batch["base"]):
                out = []
                for doc_id, start, ids in documents_of(file, kind):
                    out.append((doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(out) == rows:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
                yield pd.DataFrame(out, columns=columns).astype("int64")

    spread = files.select("file", "kind", "base").repartition(max(1, min(1024, files.count())), "file")
    found = spread.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return found.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))

"""Token ids of documents as length-delimited binary records, with an offset index.

A data file is a run of records, little-endian throughout:

    8  payload length n        4  masked crc32 of the length bytes
    n  payload                 4  masked crc32 of the payload          1  0x0A

and a payload is 1 byte of flags (1: the id is null), 8 bytes document id, 1 byte
id width (2 or 4), then the ids. A masked checksum is the crc32 rotated right by
15 bits plus 0xA282EAD8. The closing byte lets Spark's own text writer commit the
files, to any store and with retried tasks leaving nothing behind. File names sort
in document order. The index, a Parquet table beside the data, gives for each
record its file, byte offset, length, document id, token counts and a checksum of its ids as
read back from the files, so that single records can be read in any order.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import give_back, map_arrow
from ledgerlens.plans import scratch

END_ID = 2
_MASK = 0xA282EAD8
#: Words that a worker remembers at most.
CACHE_WORDS = 250_000
#: Longer texts are cut into pieces of about as many characters before their words are told apart.
PIECE_CHARS = 4_000_000
#: Characters of texts that are encoded at once, about.
BATCH_CHARS = 4_000_000
#: Bytes of text that a data file is meant for; a file must be read whole, so it has to stay far below 2 GB.
FILE_BYTES = 256_000_000
_HEAD = struct.Struct("<QI")
_META = struct.Struct("<BqB")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    n = struct.pack("<Q", len(payload))
    return n + struct.pack("<I", masked(n)) + payload + struct.pack("<I", masked(payload)) + b"\n"


def records(data: bytes):
    """(offset, length of the whole record, payload) of every record; raises ValueError on damage."""
    at = 0
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError(f"record cut short at byte {at}")
        n, check = _HEAD.unpack_from(data, at)
        if check != masked(data[at : at + 8]):
            raise ValueError(f"bad length checksum at byte {at}")
        end = at + 12 + n + 5
        payload = data[at + 12 : at + 12 + n]
        if end > len(data) or struct.unpack_from("<I", data, end - 5)[0] != masked(payload) or data[end - 1] != 10:
            raise ValueError(f"bad payload checksum at byte {at}")
        yield at, end - at, payload
        at = end


def encode_payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return _META.pack(doc_id is None, doc_id or 0, width) + ids


def decode_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    null, doc_id, width = _META.unpack_from(payload)
    return None if null else doc_id, np.frombuffer(payload, "<u2" if width == 2 else "<u4", offset=_META.size).astype("<u4")


_IRREGULAR = re.compile(r"[ \n]\s|\s[ \n]|\A[ \n]|[ \n]\Z")
_BREAK = re.compile(r"(?= \S)")
_POINTS = frozenset(",.;:!?")
_OTHER_SPACES = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")


def _irregular(text: str) -> bool:
    """Whether a space or line break stands at an end or beside other white space; cheap tests first."""
    if text[0].isspace() or text[-1].isspace() or "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
        return True
    return any(c in text for c in _OTHER_SPACES) and _IRREGULAR.search(text) is not None


def cuts_at_spaces(tok) -> bool:
    """Whether a tokenizer has the splitting rule that `Encoder` cuts by: byte-level with its own pattern, nothing before or after."""
    pre, model = tok.pre_tokenizer, tok.model
    plain = tok.normalizer is None and tok.truncation is None and tok.padding is None and tok.post_processor is None
    return plain and type(pre).__name__ == "ByteLevel" and pre.use_regex and not pre.add_prefix_space and type(model).__name__ == "BPE" and not model.dropout


class Encoder:
    """Ids of whole texts, as the tokenizers library gives them, each distinct word encoded once while it is remembered.

    A byte-level vocabulary's splitting rule never joins what stands before a space with a
    following non-space, nor a line break between two non-spaces with what stands before
    it, so texts may be cut there and the parts' ids joined. Where white space is less
    regular, only the first kind of cut is made. Words go to the library many at a time,
    cut apart again by the byte lengths of their tokens. Texts that hold a special token's string, and
    all texts of a vocabulary with another rule, go to the library whole.
    """

    def __init__(self, path: str, specials_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = specials_as_text
        self.cuts = cuts_at_spaces(self.tok)
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values() if not (specials_as_text and t.special)]
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocab.values()) < 1 << 16 else 4
        self.kind = f"<u{self.width}"
        size = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            size[i] = len(token)  # byte-level vocabularies write one character per byte
        self.size = size
        self.words: dict[str, bytes] = {}  # "x" stands for " x", "\nx" for itself
        self.room = CACHE_WORDS
        self.points = {c: self._ids(c) for c in _POINTS}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, new: list[str]) -> None:
        """Remember distinct words that are not remembered yet."""
        known = self.words
        stems = {w: w[:-1] for w in new if w[-1:] in _POINTS and w[:-1].isalpha()}
        need = [w for w in new if w not in stems]
        need += set(stems.values()).difference(need).difference(known)
        parts = [w if w[:1] == "\n" else " " + w for w in need]
        if parts:
            ids = np.array(self.tok.encode_batch_fast(["".join(parts)], add_special_tokens=False)[0].ids, self.kind)
            lengths = pc.binary_length(pa.array(parts, pa.large_string())).to_numpy()
            cuts = (np.searchsorted(np.cumsum(self.size[ids]), np.cumsum(lengths), "left") + 1) * self.width
            flat, at = ids.tobytes(), 0
            for w, c in zip(need, cuts.tolist()):
                known[w] = flat[at:c]
                at = c
        for w, stem in stems.items():
            known[w] = known[stem] + self.points[w[-1]]

    def _remembered(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words. Of a full memory only the words asked for now stay: most others never return."""
        ids = list(map(self.words.get, words))
        if len(self.words) > self.room:
            self.words = {w: i for w, i in zip(words, ids) if i is not None}
        missing = [w for w, i in zip(words, ids) if i is None]
        if missing:
            for i in range(0, len(missing), 5000):
                self._learn([w for w in missing[i : i + 5000] if w not in self.words])
            ids = list(map(self.words.__getitem__, words))
        return ids

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, cut at single spaces and before line breaks. Each begins with a word, or with the space before one."""
        if not pieces:
            return []
        # a line break before each piece keeps its first word from being taken for one after a space; its one id is left out below
        cut = pc.replace_substring(pa.array(pieces, pa.large_string()), "\n", " \n")
        lists = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\n", pa.large_string()), cut, pa.scalar("", pa.large_string())), " ")
        coded = lists.flatten().dictionary_encode()
        found = self._remembered(coded.dictionary.to_pylist())
        table = np.empty(len(found), object)
        table[:] = found
        ids = table[coded.indices.to_numpy()]
        edge = np.asarray(lists.offsets).tolist()
        return [b"".join(ids[a:b].tolist())[self.width :] for a, b in zip(edge, edge[1:])]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of every text. Distinct words of all texts together are looked up once."""
        out: list[list[bytes] | bytes] = []
        pieces: list[str] = []
        where: list[int] = []
        for i, t in enumerate(texts):
            if not self.cuts or not t or any(s in t for s in self.specials) or _irregular(t):
                out.append(self.encode(t))
                continue
            out.append([])
            at = 0
            while at < len(t):  # very long texts in pieces that end before a space
                to = len(t) if len(t) - at <= PIECE_CHARS else t.find(" ", at + PIECE_CHARS)
                to = len(t) if to < 0 else to
                pieces.append(t[at:to])
                where.append(i)
                at = to
        for i, ids in zip(where, self._pieces(pieces)):
            out[i].append(ids)
        return [b"".join(x) if isinstance(x, list) else x for x in out]

    def encode(self, text: str) -> bytes:
        """Ids of one text, by the library where words can't be cut apart safely."""
        if not text:
            return b""
        if not self.cuts or any(s in text for s in self.specials):
            return self._ids(text)
        if not _irregular(text):
            return self.encode_all([text])[0]
        first, *rest = _BREAK.split(text)
        # parts keep their spaces; those that hold more white space are encoded as they are
        return self._ids(first) + b"".join(self._rest(rest))

    def _joined(self, words: list[str]) -> bytes:
        own = list(dict.fromkeys(words))
        known = dict(zip(own, self._remembered(own)))
        return b"".join(map(known.__getitem__, words))

    def _rest(self, parts: list[str]):
        plain: list[str] = []
        for p in parts:  # each begins with a space and a non-space
            if p.count(" ") == 1 and len(p.split()) == 1 and not p[-1].isspace():
                plain.append(p[1:])
            else:
                if plain:
                    yield self._joined(plain)
                    plain = []
                yield self._ids(p)
        if plain:
            yield self._joined(plain)


@cache
def encoder(path: str, specials_as_text: bool = False) -> Encoder:
    return Encoder(path, specials_as_text)


def write(docs: DataFrame, out: str, vocabulary: str | None = None, end_id: int = END_ID, files: int | None = None, specials_as_text: bool = False) -> None:
    """Encode every row of ``docs(doc_id, text)`` to ``<out>/data`` and index it in ``<out>/index``.

    Rows go in ascending doc_id order, null ids first, rows of one id by a hash of their text; rows that repeat both
    may be dealt to several files. Null and empty texts are records with the end id alone. An empty table gives no record.
    Other columns are ignored. A special token's string in a text becomes that token's id, as the library does,
    unless ``specials_as_text``. Without ``files`` their number follows from the length of all texts, see FILE_BYTES.
    """
    path = vocabulary or vocabulary_path()

    def run(batches):
        enc = encoder(path, specials_as_text)
        end = np.array([end_id], enc.kind).tobytes()

        def rows(ids, texts):
            framed = [frame(encode_payload(d, x + end, enc.width))[:-1] for d, x in zip(ids, enc.encode_all(texts))]
            return pa.RecordBatch.from_arrays([pa.array(framed, pa.binary())], names=["value"])

        ids, texts, held = [], [], 0
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids.append(d)
                texts.append(t or "")
                held += len(texts[-1])
                if held >= BATCH_CHARS:
                    yield rows(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield rows(ids, texts)
        ids, texts = [], []
        give_back()

    spark = docs.sparkSession
    n = files
    if n is None:
        size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    # the third key splits what repeats one id and text very often
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns({"h": F.xxhash64("text"), "k": F.monotonically_increasing_id()})
    dealt = rows.repartitionByRange(n, "doc_id", "h", "k").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    map_arrow(dealt, run, "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").text(f"{out}/data")
    index(spark, out)


def _files(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{out}/data").select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


_INDEX = "file string, offset long, length long, doc_id long, n_tokens long, start_in_file long, ids_crc32 long"


def read(spark: SparkSession, out: str) -> DataFrame:
    """Every record of the data files, its checksums verified: file, offset, length, doc_id, n_tokens, start_in_file, ids_crc32."""
    names, kinds = [x.split(" ")[0] for x in _INDEX.split(", ")], [pa.string(), *[pa.int64()] * 6]

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows, start = [], 0
                for at, size, payload in records(data):
                    doc_id, ids = decode_payload(payload)
                    rows.append((name, at, size, doc_id, len(ids), start, zlib.crc32(ids.tobytes())))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, kinds)], names=names)

    return map_arrow(_files(spark, out), run, _INDEX)


def index(spark: SparkSession, out: str) -> None:
    """Read the data files back and write what ``read`` gives to <out>/index."""
    read(spark, out).write.parquet(f"{out}/index")


def read_index(spark: SparkSession, out: str) -> DataFrame:
    """The index with ``start``: tokens of all records before it, over all files."""
    table = spark.read.parquet(f"{out}/index")
    part = F.regexp_extract("file", "^part-([0-9]+)", 1).cast("long")  # as a number: names of over 99,999 parts don't sort
    totals = table.groupBy("file").agg(F.sum("n_tokens").alias("n"))  # one row a file
    base = totals.withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("file", "base")
    return table.join(base, "file").withColumn("start", F.col("base") + F.col("start_in_file")).drop("base")


def digest(docs: DataFrame, out: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """Write ``docs``, read the files back and return (doc_id, start, n_tokens, ids_crc32) of every record."""
    spark = docs.sparkSession
    out = out or scratch.new_path(spark, "tokens")
    write(docs, out, vocabulary)
    return read_index(spark, out).select("doc_id", "start", "n_tokens", "ids_crc32")

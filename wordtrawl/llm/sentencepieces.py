"""SentencePiece encoding that keeps offsets, and decoding.

``Normalizer`` applies a model's compiled character map: at each place the longest prefix that the map's trie knows is
replaced, anything else is kept, and every byte of the normal form remembers the byte of the source it came from. White
space is escaped, a leading mark is added and extra blanks are removed as the model says. ``Codec`` cuts the normal form
into stretches that no piece can cross (each begins at a word mark), lets the library merge each distinct stretch once, and
projects every piece through the alignment to a span of bytes of the source.

Defined cases: a null text counts as empty and has the end id only; texts of any length are encoded whole; repeated rows
are encoded each; a null id is kept.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from wordtrawl.llm.common import ship

MARK = "▁"
#: Stretches whose ids a worker remembers; beyond it the memory starts afresh.
REMEMBERED = 200_000


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8 prefixes, and the strings that replace them."""

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob)
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.strings = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix of ``text[at:]`` and its replacement."""
        units, found = self.units, None
        node = self._offset(units[0])
        for place in range(at, len(text)):
            byte = text[place]
            node ^= byte
            if node >= len(units):
                break
            unit = units[node]
            if (unit & 0x800000FF) != byte:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = place + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.strings[start : self.strings.index(b"\0", start)]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)


class Normalizer:
    """Normal form of a text and, for each of its bytes and its end, the source byte it stands for."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    @property
    def keeps_characters(self) -> bool:
        return self.map is None and not self.squeeze and self.escape and self.prefix

    def normalize(self, text: str) -> tuple[bytes, np.ndarray]:
        source = text.encode()
        return self._plain(source) if self.keeps_characters else self._mapped(source)

    def _plain(self, source: bytes) -> tuple[bytes, np.ndarray]:
        if not source:
            return b"", np.zeros(1, np.int32)
        sizes = np.where(np.frombuffer(source, np.uint8) == 32, 3, 1)
        places = np.repeat(np.arange(len(source), dtype=np.int32), sizes)
        mark = MARK.encode()
        return mark + source.replace(b" ", mark), np.concatenate([np.zeros(3, np.int32), places, np.int32([len(source)])])

    def _mapped(self, source: bytes) -> tuple[bytes, np.ndarray]:
        blank = MARK.encode() if self.escape else b" "
        out, places, at = bytearray(), [], 0

        def put(piece: bytes, place: int) -> None:
            out.extend(piece)
            places.extend([place] * len(piece))

        units = []
        while at < len(source):
            match = self.map.longest(source, at) if self.map else None
            if match is None:
                lead = source[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                match = size, source[at : at + size]
            units.append((at, match[1]))
            at += match[0]
        end = len(source)
        if self.squeeze:
            while units and units[0][1].strip(b" ") == b"":
                units.pop(0)
        if units and self.prefix:
            put(blank, units[0][0])
        before = self.squeeze
        for place, piece in units:
            if self.squeeze:
                while before and piece.startswith(b" "):
                    piece = piece[1:]
            if piece:
                for byte in piece:
                    put(blank if byte == 32 else bytes([byte]), place)
                before = self.squeeze and piece.endswith(b" ")
        if self.squeeze:
            while out.endswith(blank) and out:
                end = places[-1]
                del out[-len(blank) :]
                del places[-len(blank) :]
        return bytes(out), np.array([*places, end], np.int32)


class Codec:
    """Ids, spans and decoded texts of one model."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normalizer = Normalizer(proto.normalizer_spec)
        self.sizes = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces], np.int32)
        self.end_id = self.library.eos_id()
        # A piece with a mark inside, or one that the user defined, could cross a stretch.
        crossing = any(MARK in p.piece.lstrip(MARK) or p.type == 4 for p in proto.pieces)
        unknown = not proto.trainer_spec.byte_fallback
        self.cuts = self.normalizer.keeps_characters and not crossing and not unknown
        self.exact_sizes = not unknown
        self.known: dict[str, list[int]] = {}

    def ids(self, text: str) -> list[int]:
        """The library's ids of a text, without the end id."""
        if not self.cuts or not text:
            return self.library.encode(text) if text else []
        words = text.split(" ")
        parts = list(map(self.known.get, words))
        if None in parts:
            missing = list({w for w, p in zip(words, parts) if p is None})
            if "" in missing or any(MARK in w for w in missing):
                return self.library.encode(text)
            if len(self.known) + len(missing) > REMEMBERED:
                self.known.clear()
                missing = list(set(words))
                if "" in missing or any(MARK in w for w in missing):
                    return self.library.encode(text)
            self.known.update(zip(missing, self.library.encode(missing, num_threads=1)))
            parts = map(self.known.__getitem__, words)
        out: list[int] = []
        for part in parts:
            out += part
        return out

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last source byte of every piece."""
        normal, places = self.normalizer.normalize(text)
        if self.exact_sizes:
            sizes = self.sizes[ids]
        else:
            pieces = self.library.encode(text, return_type="proto").pieces
            sizes = np.array([len(p.piece.encode()) for p in pieces], np.int32)
        ends = np.cumsum(sizes)
        if len(ends) and ends[-1] != len(normal):
            raise ValueError("the pieces do not cover the normal form")
        return places[ends - sizes], places[ends]


@lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    return Codec(model)


def read_model(path: str) -> bytes:
    """The model's bytes; they travel with the tasks, so that only the driver needs the file."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, text: str = "text", key: str = "doc_id", digests: bool = False) -> DataFrame:
    """Encode every whole text, end id last, and decode it again.

    (key, ids, starts, ends, decoded): pieces and their byte spans in the source, the end id with an empty span at the end.
    With ``digests`` instead (key, n_tokens, ids_sha256, decoded_sha256, spans_crc32), made of the same values.
    """
    ship(docs.sparkSession)
    key_type = docs.schema[key].dataType.simpleString()
    lists = pa.list_(pa.int32())
    full = pa.schema([("ids", lists), ("starts", lists), ("ends", lists), ("decoded", pa.string())])
    long, string = pa.int64(), pa.string()
    short = pa.schema([("n_tokens", long), ("ids_sha256", string), ("decoded_sha256", string), ("spans_crc32", long)])

    def one(worker: Codec, body: str | None) -> tuple:
        body = body or ""
        ids = worker.ids(body)
        starts, ends = worker.spans(body, ids)
        ids.append(worker.end_id)
        decoded = worker.library.decode(ids)
        if digests:
            written = " ".join(map(str, ids)).encode()
            spans = zlib.crc32(ends.astype("<i4").tobytes(), zlib.crc32(starts.astype("<i4").tobytes()))
            return len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), spans
        size = len(body.encode())
        return ids, np.append(starts, size), np.append(ends, size), decoded

    def encoded(batches):
        worker = codec(model)
        for batch in batches:
            # Few texts at a time, so that the pieces of long ones do not pile up.
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = [one(worker, body.as_py()) for body in part.column("body")]
                schema = short if digests else full
                columns = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(schema)]
                yield pa.RecordBatch.from_arrays([part.column("key"), *columns], names=["key", *schema.names])

    columns = (
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_crc32 bigint"
        if digests
        else "ids array<int>, starts array<int>, ends array<int>, decoded string"
    )
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    return rows.mapInArrow(encoded, f"key {key_type}, {columns}").withColumnRenamed("key", key)

"""Offset-preserving encoding with a SentencePiece vocabulary, and its decoding.

A text is normalised the way the model file says: at each place the longest prefix that the model's compiled character
map (a double-array trie) knows is replaced, any other character is copied, blanks are escaped and the leading blank is
added. Every normalised byte keeps the place in the source that it came from. The pieces' lengths, added up over the
normalised text, give the pieces' ends there, and the kept places project them to spans of the source's bytes.

Segmentation (merging pieces by rank) is the library's. Where the model has no piece that goes on after a blank, words
are segmented each by itself, and a worker's cache keeps what it has met. That pieces and the normalised text here have the same
length is checked for every text, so an alignment cannot go wrong silently.
"""

from __future__ import annotations

import re
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text
from .textio import Texts, chunks

SPACE = "▁".encode()
#: Bytes of text that a worker encodes at a time (a longer text is alone).
CHUNK = 1 << 19
#: Ids that a worker decodes at a time (a longer text is alone).
DECODED = 100_000
#: Words that a worker's cache may hold before it starts anew, and their greatest length there.
CACHE_WORDS, CACHE_LENGTH = 200_000, 32
#: Words that the library gets as one text.
JOINED = 200
#: A word with the blanks before it (the last one of a text: those after it, too), in the text or in its normalised form.
WORD = re.compile(r"[ ▁]+[^ ▁]+(?:[ ▁]+\Z)?|[ ▁]+")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)  # Fixed values: kinds of pieces in a model file


class CharMap:
    """The compiled character map: a double-array trie from byte strings to their replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.strings = blob[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest known prefix of ``text[at:]``."""
        units, found = self.units, None
        if not units:
            return None
        node = self._child(units[0])
        for end in range(at, len(text)):
            node ^= text[end]
            if node >= len(units) or units[node] & 0x800000FF != text[end]:  # another byte's unit, or a value
                break
            unit = units[node]
            node ^= self._child(unit)
            if unit >> 8 & 1:
                found = end + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.strings[found[1]:self.strings.index(b"\0", found[1])]

    @staticmethod
    def _child(unit: int) -> int:
        return unit >> 10 << (8 if unit >> 9 & 1 else 0)


class Normaliser:
    """Normalises UTF-8 texts; ``spec`` is the model file's part about it, ``symbols`` are strings copied as they stand."""

    def __init__(self, spec, suffix: bool = False, symbols: tuple[bytes, ...] = ()):
        self.map = CharMap(spec.precompiled_charsmap)
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix, self.symbols = suffix, sorted(symbols, key=len, reverse=True)
        self.plain = not (self.map.units or self.trim or self.suffix or self.symbols)

    def places(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """For plain models: the place in ``t.data`` of every normalised byte of all the texts, and each text's number of
        normalised bytes. No bytes change but blanks, so only their widths matter. A character's bytes share its place."""
        b, blank = t.data, len(SPACE) if self.escape else 1
        width = np.where(b == 32, blank, 1)
        place = np.maximum.accumulate(np.where(b & 0xC0 != 0x80, np.arange(len(b)), 0)) if len(b) else np.zeros(0, np.int64)
        live = t.starts[:-1][np.diff(t.starts) > 0]
        if self.prefix:
            width, place = np.insert(width, live, blank), np.insert(place, live, live)
        total = np.concatenate([[0], np.cumsum(np.where(b == 32, blank, 1))])
        size = np.diff(total[t.starts]) + (blank if self.prefix else 0) * (np.diff(t.starts) > 0)
        return np.repeat(place, width), size

    def _step(self, text: bytes, at: int) -> tuple[int, bytes]:
        for s in self.symbols:
            if text.startswith(s, at):
                return len(s), s
        found = self.map.longest(text, at)
        if found is not None:
            return found
        lead = text[at]
        n = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return n, text[at:at + n]

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, for each of them and for the end its place in ``text``)."""
        at, blank = 0, SPACE if self.escape else b" "
        while self.trim and at < len(text):
            n, put = self._step(text, at)
            if put != b" ":
                break
            at += n
        if at >= len(text):
            return b"", np.zeros(1, np.int64)
        out, place, after_blank = bytearray(), [], self.trim
        if self.prefix and not self.suffix:
            out += blank
            place += [at] * len(blank)
        while at < len(text):
            n, put = self._step(text, at)
            if after_blank:
                put = put.lstrip(b" ")
            if put:
                shown = put.replace(b" ", blank)
                out += shown
                place += [at] * len(shown)
                after_blank = put.endswith(b" ")
            at += n
            after_blank = after_blank and self.trim
        while self.trim and out.endswith(blank):
            at = place[len(out) - len(blank)]
            del out[len(out) - len(blank):], place[len(place) - len(blank):]
        if self.suffix and self.prefix:
            out += blank
            place += [at] * len(blank)
        return bytes(out), np.array([*place, at])


class Encoder:
    """Ids and source spans of texts under one model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto.FromString(self.lib.serialized_model_proto())
        kinds = np.array([p.type for p in model.pieces])
        self.unknown = int(np.flatnonzero(kinds == UNKNOWN)[0])
        self.lengths = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.normalise = Normaliser(model.normalizer_spec, model.trainer_spec.treat_whitespace_as_suffix,
                                    tuple(p.piece.encode() for p in model.pieces if p.type == USER))
        n, self.byte_fallback = self.normalise, model.trainer_spec.byte_fallback
        self.by_word = (n.plain and n.prefix and n.escape and self.byte_fallback
                        and not any(re.search("[^▁]▁", p.piece) for p in model.pieces))
        self.cache: dict[str, bytes] = {}  # a word's ids, 32 bits each

    def segment(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's ids."""
        if not self.by_word:
            return [np.asarray(x, np.int32) for x in self.lib.encode(texts, num_threads=1)]
        words = [WORD.findall(" " + t) if t else [] for t in texts]  # the blank that the model adds before a text
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        missing = list(set(chain.from_iterable(words)).difference(self.cache))
        if missing:  # some hundred make a text, which is cut again where they end; the library adds its first blank
            missing.sort(key=lambda w: w[-1] in " ▁")
            solid = sum(w[-1] not in " ▁" for w in missing)  # the others, at ends of texts, would merge with what follows
            joined = ["".join(missing[i:min(i + JOINED, solid)])[1:] for i in range(0, solid, JOINED)] + [w[1:] for w in missing[solid:]]
            ids = np.fromiter(chain.from_iterable(self.lib.encode(joined, num_threads=1)), np.int32)
            ends = np.cumsum([len(w.encode()) + w.count(" ") * (len(SPACE) - 1) for w in missing])
            cut = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
            packed, cut = ids.tobytes(), (cut * ids.itemsize).tolist()
            self.cache.update(zip(missing, map(packed.__getitem__, map(slice, [0, *cut], cut))))
        out = [np.frombuffer(b"".join(map(self.cache.__getitem__, w)), np.int32) for w in words]
        for w in missing:
            if len(w) > CACHE_LENGTH:
                del self.cache[w]
        return out

    def spans(self, text: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of each piece's source bytes. Bytes of one character that are pieces of their own all have its
        start; the last one has its end."""
        normal, place = self.normalise(text)
        width = self.lengths[ids]
        if (ids == self.unknown).any():  # an unknown piece stands for what the text has there
            width = np.array([1 if i != self.unknown and len(p) == 6 and p.startswith("<0x") and self.lengths[i] == 1 else len(p.encode())
                              for i, p in zip(ids.tolist(), self.lib.encode(text.decode(), out_type=str))], np.int64)
        end = np.cumsum(width)
        if len(normal) != (end[-1] if len(end) else 0):
            raise ValueError(f"pieces cover {end[-1] if len(end) else 0} of {len(normal)} normalised bytes")
        return place[end - width], place[end]

    def batch(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, ends of all texts' pieces, number of pieces of each text)."""
        raw = [t.data[s:e].tobytes() for s, e in zip(t.starts[:-1], t.starts[1:])]
        found = self.segment([x.decode() for x in raw])
        n = np.array([len(i) for i in found], np.int64)
        ids = np.concatenate([np.zeros(0, np.int32), *found])
        if not (self.normalise.plain and self.byte_fallback):
            spans = [self.spans(x, i) for x, i in zip(raw, found)]
            return ids, *(np.concatenate([np.zeros(0, np.int32), *(s[k] for s in spans)]).astype(np.int32) for k in (0, 1)), n
        place, size = self.normalise.places(t)
        width = self.lengths[ids]
        end = np.cumsum(width)
        last = np.cumsum(n)
        covered = np.concatenate([[0], end])[last]
        if (covered != np.cumsum(size)).any():
            raise ValueError("pieces and normalised texts differ in length")
        place = np.append(place, len(t.data))
        first = np.repeat(t.starts[:-1], n)
        return ids, (place[end - width] - first).astype(np.int32), (place[end] - first).astype(np.int32), n


class _Worker:
    """One encoder for each model file in a Python worker, kept from task to task."""
    kept: dict[str, Encoder] = {}

    def __init__(self, path: str):
        self.path = path

    @cached_property
    def encoder(self) -> Encoder:
        if self.path not in self.kept:
            self.kept[self.path] = Encoder(self.path)
        return self.kept[self.path]


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, ids, starts, ends: a row for each row of ``docs``, in any order.

    ids: the whole text's ids as the library gives them, without begin or end ids; starts, ends: each piece's span in
    the text's UTF-8 bytes (32-bit, as Spark's strings). Null and empty texts have no ids; repeated rows and null ids
    each give their row; an empty table gives no rows. ``path``: a model file that every worker can open.
    """
    def work(batches):
        encoder = _Worker(path).encoder
        for b in batches:
            for lo, hi, t in chunks(b.column(1), CHUNK):
                ids, start, end, n = encoder.batch(t)
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (ids, start, end)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(np.diff(t.starts).astype(np.int64)), *lists],
                                                 names=["doc_id", "n_bytes", "ids", "starts", "ends"])

    d = doc_text(docs, text).withColumn("text", F.coalesce("text", F.lit("")))
    return d.mapInArrow(work, "doc_id long, n_bytes long, ids array<int>, starts array<int>, ends array<int>")


def decode(ids, path: str):
    """Column: the text of an array of ids as the library's decode(ids) gives it (null array: null)."""
    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        lib, out = _Worker(path).encoder.lib, []
        before = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        hi = 0
        while hi < len(column):
            lo, hi = hi, max(hi + 1, int(np.searchsorted(before, before[hi] + DECODED, "right")) - 1)
            rows = column.slice(lo, hi - lo)
            live = rows.drop_null()
            ids, ends = live.flatten().to_numpy(zero_copy_only=False), np.cumsum(live.value_lengths().to_numpy(zero_copy_only=False))
            lists = [x.tolist() for x in np.split(ids, ends[:-1])] if len(live) else []
            done = iter(lib.decode(lists, num_threads=1) if lists else [])
            out += [next(done) if ok else None for ok in rows.is_valid().to_pylist()]
        return pa.array(out, pa.string())

    return text(ids)


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256, n_bytes, covered_bytes (bytes of the
    text inside pieces' spans): a row for each row of ``docs``, handled as ``encode`` says."""
    e = encode(docs, path, text)
    covered = F.aggregate(F.zip_with("starts", "ends", lambda s, x: x - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return e.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                    F.sha2(decode(F.col("ids"), path), 256).alias("decoded_sha256"), "n_bytes", covered.alias("covered_bytes"))

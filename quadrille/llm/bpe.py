"""Operator 10: exact byte-pair encoding by backtracking, and decoding through an offset table.

Encoder. Repeated merging of the best pair is replaced by a search over
positions: an Aho-Corasick automaton finds the longest vocabulary entry at a
position, and links lead from each entry to the next shorter one that begins
it; the encoder takes the longest that is compatible with the entry before
it, and steps back when none is. Two entries are
compatible if merging their concatenation would give just these two, which
is decided by undoing merges at their border, latest first, and is kept in a
pair table. A position that failed once is never tried again, so the work is
linear in the word's length. Words are encoded once per batch worker and kept
in a bounded table.

Decoder. All entries' spellings form one byte buffer with an offset table;
a batch of ids is decoded by gathers from it.

Null is the empty text, which has no ids and decodes to nothing. Nothing is
truncated or padded, whatever a text's length. Every row is encoded by itself,
so rows that repeat an id or a text are rows of the result. Only id and text are
read.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: The printable stand-ins of byte-level vocabularies keep these byte ranges as they are.
_KEPT_RANGES = ((33, 126), (161, 172), (174, 255))


def _byte_letters() -> list[str]:
    kept = {b for lo, hi in _KEPT_RANGES for b in range(lo, hi + 1)}
    letters, spare = [], 256
    for b in range(256):
        if b in kept:
            letters.append(chr(b))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


#: Unicode's white space, as the contents of a character class.
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


#: The parts of a vocabulary file that this encoder stands for; a file with others is refused.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_SPLIT = {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}
_PLAIN_MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}


def _check(spec: dict) -> None:
    pre = spec.get("pre_tokenizer") or {}
    parts = pre.get("pretokenizers") or []
    levels = [p for p in parts if p.get("type") == "ByteLevel"]
    bytewise = len(parts) == 2 and len(levels) == 1 and not levels[0].get("add_prefix_space") and not levels[0].get("use_regex")
    same = {
        "normalizer": spec.get("normalizer") == _NORMALIZER,
        "pre_tokenizer": bytewise and parts[0] == _SPLIT,
        "decoder": spec.get("decoder") is None,
        "model": all(spec["model"].get(k, v) == v for k, v in _PLAIN_MODEL.items()),
        "added_tokens": not any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")),
    }
    other = [k for k, v in same.items() if not v]
    if other:
        raise ValueError(f"this encoder does not know the file's {', '.join(other)}")


class _Table(dict):
    """A bounded table of encoded words: when it is full it becomes the old generation, from which words in use come back."""

    def __init__(self, encode, keep: int):
        self.encode, self.keep, self.old = encode, keep, {}

    def __missing__(self, token: str) -> bytes:
        ids = self.old.get(token)
        if ids is None:
            ids = self.encode(token)
        if len(token) <= 64:
            if len(self) >= self.keep:
                self.old = dict(self)
                self.clear()
            self[token] = ids
        return ids


class WordBpe:
    """A word-level BPE vocabulary file of the tokenizers library: NFC, blanks to one space, lower case, split by a pattern, byte letters, merges with a word-end mark."""

    #: An offset that makes a last letter another letter than the same one inside a word.
    END = 0x10000
    KEEP = 400_000  # words in each of the two generations of the table of encoded words

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        _check(spec)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern.replace(r"[^\s", "[^" + _BLANK))
        # The same pattern for texts of Latin-1 letters alone, which the plain engine takes faster.
        letters, numbers = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe"
        self.latin = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^ \t-\r\x85\xa0{letters}{numbers}]+")
        self.not_latin = re.compile(r"[^\x00-\xff]")
        self.blanks = regex.compile(f"[{_BLANK}]+")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.letters = _byte_letters()
        vocab = model["vocab"]
        self.spelling = {i: t for t, i in vocab.items()} | {i: t for t, i in special.items()}

        # Order of creation: single letters first (order 0..), then merges by rank.
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        made = {a + b for a, b in merges}
        order = [t for t in vocab if t not in made]
        self.order_of = {t: k for k, t in enumerate(order)}
        self.parts: list[tuple[int, int]] = [(k, k) for k in range(len(order))]
        self.whole: dict[tuple[int, int], int] = {}
        for a, b in merges:
            k = len(order)
            pair = (self.order_of[a], self.order_of[b])
            if a + b in self.order_of:  # a second way to the same entry never wins
                continue
            self.order_of[a + b] = k
            order.append(a + b)
            self.parts.append(pair)
            self.whole[pair] = k
        self.ids = [vocab[t] for t in order]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.coded = [self._coded(t) for t in order]
        for k, w in enumerate(self.coded):
            self.automaton.add_word(w, k)
        self.automaton.make_automaton()
        self.coded_at = {w: k for k, w in enumerate(self.coded)}
        self.lengths = [len(w) for w in self.coded]
        #: For each entry, the longest shorter one that begins it, or -1.
        self.shorter = [next((self.coded_at[w[:i]] for i in range(len(w) - 1, 0, -1) if w[:i] in self.coded_at), -1) for w in self.coded]
        self.pairs: dict[int, bool] = {}
        self.words = _Table(self.word, self.KEEP)

        top = max(self.spelling) + 1
        texts = [(self.spelling.get(i, "")).encode() + b" " for i in range(top)]
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.blob = np.frombuffer(b"".join(texts), np.uint8)

    def _coded(self, entry: str) -> str:
        if self.suffix and entry.endswith(self.suffix):
            inner = entry[: -len(self.suffix)]
            return inner[:-1] + chr(ord(inner[-1]) + self.END)
        return entry

    # -- pair table

    def compatible(self, left: int, right: int) -> bool:
        """Whether the letters of left and right together merge into just these two entries."""
        key = left << 20 | right
        found = self.pairs.get(key)
        if found is None:
            found = self.pairs[key] = self._compatible(left, right)
            if len(self.pairs) > self.KEEP:
                self.pairs.clear()
        return found

    def _compatible(self, left: int, right: int) -> bool:
        # Undo, latest first, the merges that hid the symbols at the border. While a and b are both
        # there, a merge of them must come before the earlier of the merges that take them up.
        a, b = left, right
        limit = len(self.parts)
        while True:
            across = self.whole.get((a, b))
            if across is not None and across < limit:
                return False
            if a > b and self.parts[a][0] != a or self.parts[b][0] == b:
                if self.parts[a][0] == a:
                    return True
                limit, a = a, self.parts[a][1]
            else:
                limit, b = b + 1, self.parts[b][0]  # equal merges go from left to right

    # -- words

    def _word(self, word: str) -> list[int]:
        found = self.coded_at.get(word)
        if found is not None:
            return [found]
        # First the longest entries from left to right; mostly few of them are incompatible.
        lengths, pairs, shorter = self.lengths, self.pairs, self.shorter
        longest: dict[int, int] = {}
        pos, last, fine = 0, -1, True
        for end, k in self.automaton.iter_long(word):
            longest[end + 1 - lengths[k]] = k
            if fine and last >= 0:
                fits = pairs.get(last << 20 | k)
                fine = fits if fits is not None else self.compatible(last, k)
            last = k
        if fine:
            return list(longest.values())
        n = len(word)
        out: list[int] = []
        dead = bytearray(n + 1)
        last, k = -1, longest[0]
        while pos < n:
            while k >= 0:
                if not dead[pos + lengths[k]]:
                    if last < 0:
                        break
                    fits = pairs.get(last << 20 | k)
                    if fits if fits is not None else self.compatible(last, k):
                        break
                k = shorter[k]
            if k >= 0:
                out.append(k)
                last = k
                pos += lengths[k]
                if pos < n:
                    k = longest.get(pos, -1)
                    if k < 0:
                        k = longest[pos] = next(self.automaton.iter_long(word, pos))[1]
            else:
                dead[pos] = 1
                if not out:
                    raise ValueError(f"no encoding for {word!r}")
                k = out.pop()
                pos -= lengths[k]
                k = shorter[k]
                last = out[-1] if out else -1
        return out

    def word(self, token: str) -> bytes:
        """The ids (little-endian unsigned 32-bit) of one piece of the split."""
        if token.isascii() and token.isprintable():  # its letters stand for themselves
            coded = token
        else:
            letters = self.letters
            coded = "".join([letters[b] for b in token.encode()])
        if self.suffix:
            coded = coded[:-1] + chr(ord(coded[-1]) + self.END)
        ids = self.ids
        out = array("I", [ids[k] for k in self._word(coded)])
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _plain(self, text: str) -> list[bytes]:
        if self.not_latin.search(text) is None:
            tokens = self.latin.findall(text.lower())
        else:
            text = self.blanks.sub(" ", unicodedata.normalize("NFC", text))
            # Letter by letter: no rule for a final sigma.
            text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
            tokens = self.split.findall(text)
        return list(map(self.words.__getitem__, tokens))

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.special_split is None or "<|" not in text and not self.special_split.search(text):
            return b"".join(self._plain(text))
        out: list[bytes] = []
        for k, part in enumerate(self.special_split.split(text)):
            out += [np.array([self.special[part]], "<u4").tobytes()] if k % 2 else self._plain(part)
        return b"".join(out)

    def decode_many(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The decoded UTF-8 of consecutive runs of ids: spellings joined by one space."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        where = np.arange(total) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        data = self.blob[where].tobytes()
        cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a : max(a, b - 1)] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


_LOADED: dict[str, WordBpe] = {}


def ship(spark: SparkSession, path: str) -> str:
    """Send a vocabulary file to all executors; the name that `load` knows it by there."""
    common.small_batches(spark)
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


def load(path: str, words_kept: int = WordBpe.KEEP) -> WordBpe:
    """One vocabulary for each file (shipped, where it is a bare name) and worker; words_kept bounds each generation of its table of words."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path if "/" in path else SparkFiles.get(path))
        common.keeps("bpe", _LOADED.clear)
    _LOADED[path].words.keep = words_kept
    return _LOADED[path]


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids array<int>, decoded): every text's ids and its decoded form, one row each as they come."""
    vocabulary = ship(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            ids = [np.frombuffer(bpe.encode(t), "<u4") for t in batch.column(1).to_pylist()]
            texts = [bpe.decode_many(x, np.array([len(x)]))[0].decode() for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256): encode_documents without shipping ids and texts."""
    vocabulary = ship(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            counts, first, second = [], [], []
            pending: list[bytes] = []

            def flush():
                if pending:
                    ids = np.frombuffer(b"".join(pending), "<u4")
                    sizes = np.array([len(p) // 4 for p in pending])
                    second.extend(hashlib.sha256(t).hexdigest() for t in bpe.decode_many(ids, sizes))
                    pending.clear()

            room = 0
            for t in batch.column(1):
                data = bpe.encode(t.as_py())
                counts.append(len(data) // 4)
                first.append(hashlib.sha256(data).hexdigest())
                pending.append(data)
                room += len(data)
                if room > 1 << 20:
                    flush()
                    room = 0
            flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

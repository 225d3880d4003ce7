"""Operator 4: BPE encoding and decoding over a pair occurrence index.

A task gathers the pre-tokens of a block of whole documents that it has not met
yet, and lays them out as one linked list of symbols. An index maps every
adjacent pair (by its merge rank) to all positions where it stands. The active
ranks are taken in ascending order; all positions of a rank are merged from left
to right, and the lists of the pairs that arise beside them are extended, while
entries of pairs that are gone are recognised and passed over. Words do not touch,
so this equals merging each word on its own. Encoded words are kept in a bounded
cache of the Python worker, only to save work.

The vocabulary file (its path is a parameter) must hold a byte-level BPE without
dropout, and every merge must come after those that make its parts; both are
checked at load. The encoding equals that of the tokenizers library without added
special tokens; the strings of special tokens in a text become those tokens.
Decoding joins the tokens with a space if the file names no decoder, and turns
byte characters back into text if it names the byte-level one.

Edge cases: null or empty text gives no ids and an empty decoded text. A text of
one very long word is one list, merged in n log n. Repeated rows and null ids are
each encoded. Unknown ids (none arise here) are skipped when decoding, null ids
lists decode as empty. An empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import id_and_text

BLOCK_CHARS = 1 << 20
CACHE_WORDS = 300_000
CACHED_WORD_CHARS = 64

#: Fixed: white space as the pattern engine of the vocabulary files sees it.
WHITE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Fixed: the split pattern of the byte-level pre-tokenizer.
BYTE_LEVEL_PATTERN = (f"'s|'t|'re|'ve|'m|'ll|'d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{WHITE}\\p{{L}}\\p{{N}}]+"
                      f"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def _ranges(points: Iterable[int]) -> str:
    """Code points as the inside of a character class."""
    return "".join(f"\\x{p:02x}" for p in points)


_LATIN = {kind: _ranges(p for p in range(256) if unicodedata.category(chr(p)).startswith(kind)) for kind in "LN"}
_LATIN_WHITE = "\\t-\\r\\x20\\x85\\xa0"


def is_latin(text: str) -> bool:
    """Whether a text has code points below 256 only."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    shown = set(printable)
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Codec:
    """A vocabulary file, read for encoding and decoding."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback"):
            raise ValueError("a byte-level BPE vocabulary without dropout is needed")
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.tokens.update({i: t for t, i in self.special.items()})
        self.left, self.right, self.made, self.rank = [], [], [], {}
        born: dict[int, int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            born.setdefault(z, r)
            self.left.append(x)
            self.right.append(y)
            self.made.append(z)
            self.rank[x << 32 | y] = r
        if any(max(born.get(x, -1), born.get(y, -1)) >= r for r, (x, y) in enumerate(zip(self.left, self.right, strict=True))):
            raise ValueError("a merge comes before those that make its parts")
        characters = byte_characters()
        self.inner = [vocab[c] for c in characters]
        self.final = [vocab[c + suffix] for c in characters]
        self._bytes = {c: b for b, c in enumerate(characters)}
        self.joins_bytes = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        self._read_steps(spec)

    def _read_steps(self, spec: dict) -> None:
        """Normalisers and the split pattern."""
        normalizer = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
        steps = normalizer.get("normalizers", [normalizer])
        kinds = [s["type"] for s in steps]
        if not set(kinds) <= {"NFC", "Replace", "Lowercase"}:
            raise ValueError(f"unknown normalisers {kinds}")
        self.steps = [(k, s) for k, s in zip(kinds, steps, strict=True) if k != "Replace"]
        for s in steps:
            if s["type"] == "Replace" and (s["pattern"], s["content"]) != ({"Regex": "\\s+"}, " "):
                raise ValueError("unknown replacement")
        pre = spec["pre_tokenizer"]
        split = next((s for s in pre.get("pretokenizers", []) if s["type"] == "Split"), None)
        if split is None:
            pattern = BYTE_LEVEL_PATTERN
        else:
            pattern = split["pattern"]["Regex"].replace("\\s", WHITE)
        # white space is folded before the split, which drops it: there is nothing to fold then
        if "Replace" in kinds and split is None:
            raise ValueError("folded white space needs a split that drops it")
        self.find_any = regex.compile(pattern).findall
        latin = pattern.replace(WHITE, _LATIN_WHITE)
        for kind, inside in _LATIN.items():
            latin = latin.replace(f"[\\p{{{kind}}}]", f"[{inside}]").replace(f" ?\\p{{{kind}}}", f" ?[{inside}]")
            latin = latin.replace(f"\\p{{{kind}}}", inside)
        self.find_latin = re.compile(latin).findall      # the same pattern for code points below 256, faster
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))

    def find(self, text: str) -> list[str]:
        return self.find_latin(text) if is_latin(text) else self.find_any(text)

    def normalise(self, text: str) -> str:
        for kind, _ in self.steps:
            if kind == "NFC":
                text = unicodedata.normalize("NFC", text)
            else:   # character by character, so a final sigma stays a sigma
                text = text.replace("Σ", "σ").lower()
        return text

    def pre_tokens(self, text: str) -> list[str | int]:
        """The pre-tokens of a text; special tokens that stand in it as their ids."""
        if not self.special or not any(s in text for s in self.special):
            return self.find(self.normalise(text))
        out: list[str | int] = []
        at = 0
        for hit in self.specials.finditer(text):
            out.extend(self.find(self.normalise(text[at:hit.start()])))
            out.append(self.special[hit.group()])
            at = hit.end()
        out.extend(self.find(self.normalise(text[at:])))
        return out

    def encode_words(self, words: Sequence[str]) -> list[list[int]]:
        """The ids of each pre-token, all merged together over one pair occurrence index."""
        symbol: list[int] = []
        begins = [0]
        for word in words:
            raw = word.encode("utf-8")
            symbol.extend([self.inner[b] for b in raw[:-1]])
            symbol.append(self.final[raw[-1]])
            begins.append(len(symbol))
        after = list(range(1, len(symbol) + 1))
        before = list(range(-1, len(symbol) - 1))
        for b in begins[1:]:
            after[b - 1] = -1
        for b in begins[:-1]:
            before[b] = -1
        rank, left, right, made = self.rank, self.left, self.right, self.made
        index: dict[int, list[int]] = {}
        for p, q in enumerate(after):
            if q > 0 and (r := rank.get(symbol[p] << 32 | symbol[q])) is not None:
                index.setdefault(r, []).append(p)
        active = list(index)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            x, y, z = left[r], right[r], made[r]
            for p in sorted(index.pop(r)):
                q = after[p]
                if q < 0 or symbol[p] != x or symbol[q] != y:
                    continue                             # the pair is gone from here
                symbol[p], symbol[q] = z, -1
                n = after[p] = after[q]
                after[q] = -1
                if n >= 0:
                    before[n] = p
                    if (s := rank.get(z << 32 | symbol[n])) is not None:
                        if s not in index:
                            index[s] = []
                            heapq.heappush(active, s)
                        index[s].append(p)
                m = before[p]
                if m >= 0 and (s := rank.get(symbol[m] << 32 | z)) is not None:
                    if s not in index:
                        index[s] = []
                        heapq.heappush(active, s)
                    index[s].append(m)
        return [[s for s in symbol[a:b] if s >= 0] for a, b in zip(begins[:-1], begins[1:], strict=True)]

    def decode(self, ids: Iterable[int]) -> str:
        try:
            tokens = list(map(self.tokens.__getitem__, ids))
        except KeyError:
            tokens = [t for i in ids if (t := self.tokens.get(i)) is not None]
        if not self.joins_bytes:
            return " ".join(tokens)
        out = bytearray()
        for t in tokens:
            if t in self.special:
                out += t.encode("utf-8")
            else:
                out += bytes(self._bytes[c] for c in t)
        return out.decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


#: Per Python worker and vocabulary: the ids of words met before, cleared beyond CACHE_WORDS.
_cache: dict[str, dict[str, list[int]]] = {}


def texts_in_blocks(column: pa.Array) -> Iterable[tuple[int, list[str]]]:
    """(first row, texts) of runs of whole documents of about BLOCK_CHARS; null as empty."""
    first, size, out = 0, 0, []
    for i in range(len(column)):
        text = column[i].as_py() or ""
        out.append(text)
        size += len(text)
        if size >= BLOCK_CHARS:
            yield first, out
            first, size, out = i + 1, 0, []
    if out:
        yield first, out


def _encoded(batches: Iterable[pa.RecordBatch], vocabulary: str) -> Iterable[pa.RecordBatch]:
    """(doc_id, ids) of batches of (doc_id, text), block by block."""
    bpe, known = codec(vocabulary), _cache.setdefault(vocabulary, {})
    for batch in batches:
        for first, texts in texts_in_blocks(batch.column(1)):
            if len(known) > CACHE_WORDS:
                known.clear()
            pre = [bpe.pre_tokens(t) for t in texts]
            new = [w for w in set().union(*pre) if w not in known and not isinstance(w, int)]
            known.update(zip(new, bpe.encode_words(new), strict=True))
            known.update((i, [i]) for i in bpe.special.values())
            ids, ends = [], [0]
            for words in pre:
                ids.extend(chain.from_iterable(map(known.__getitem__, words)))
                ends.append(len(ids))
            for w in new:
                if len(w) > CACHED_WORD_CHARS:
                    del known[w]
            lists = pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(ids, pa.int32()))
            yield pa.record_batch([batch.column(0).slice(first, len(texts)), lists], names=["doc_id", "ids"])


def _decoded(batches: Iterable[pa.RecordBatch], vocabulary: str) -> Iterable[pa.RecordBatch]:
    """(doc_id, ids, decoded) of batches of (doc_id, ids)."""
    bpe = codec(vocabulary)
    for batch in batches:
        column = batch.column(1)
        for at in range(0, len(column), 256):
            part = column.slice(at, 256)
            decoded = [bpe.decode(ids.tolist()) if ids is not None else ""
                       for ids in (x.values.to_numpy() if x.is_valid else None for x in part)]
            yield pa.record_batch([batch.column(0).slice(at, 256), part, pa.array(decoded, pa.string())],
                                  names=["doc_id", "ids", "decoded"])


ENCODED = "doc_id long, ids array<int>"
DECODED = ENCODED + ", decoded string"


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row."""
    return id_and_text(docs, id_col, text_col).mapInArrow(lambda batches: _encoded(batches, vocabulary), ENCODED)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded): the text of every list of ids, special tokens included."""
    return encoded.select("doc_id", "ids").mapInArrow(lambda batches: _decoded(batches, vocabulary), DECODED)


def encode_and_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``decode(encode(docs))``, every block decoded by the worker that encoded it.

    Two chained frames keep two Python workers alive for each task, both with the vocabulary, and hand all ids from
    one to the other through the JVM; here a task has one worker and its ids leave it once.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(
        lambda batches: _decoded(_encoded(batches, vocabulary), vocabulary), DECODED)


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

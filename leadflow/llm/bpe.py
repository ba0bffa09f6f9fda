"""BPE encoding by prefix-sharing trie traversal, and decoding.

The byte-level encoding of a prefix ends in exactly one token, and that last token fixes the whole
encoding (drop it and look at the shorter prefix). So the distinct words of a slice of rows form a
trie whose nodes each need one state: the last token of the path so far. A depth-first walk fills a
child's state from its ancestors' states, and words that share a prefix share that work. The trie is
held as the sorted list of its words: sorted order is depth-first order, and the stack is cut back
to the longest common prefix when the walk moves on.

At a node the candidates are the vocabulary entries that end there, longest first; the first one
that stays unmerged beside the last token of the prefix before it is the state. No merge list is
replayed and the cost is linear in the length of a word, also for words of megabytes.

Rows: a null text is empty; an empty text has no ids and decodes to an empty text; repeated rows
and null ids are kept as they are; other columns are not looked at.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.llm.common import returning, sliced, small_batches, text_or_empty

# Fixed value: the published split pattern of this vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space but spaces and line ends, a space beside white space, and a space between two other characters.
RARE = re.compile(r"[^\S \n]")
SPACED = re.compile(r"\s | \s")
BETWEEN = re.compile(r"(?<=\S)(?= \S)")
END = {".", ",", "!", "?", ";", ":"}
CACHE, PAIRS, HEAD = 40_000, 120_000, 32  # words and pairs of tokens that a worker keeps; beyond, it decides anew
SLICE = 1 << 19  # bytes of text whose runs are held at a time
_LOADED: dict[str, "ByteBpe"] = {}


def _byte_chars() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _newer_letters() -> str:
    """Ranges of code points that the splitter counts as letters or digits and Python's own tables
    do not know yet; the tokenizers library may class them otherwise."""
    known = regex.compile(r"[\p{L}\p{N}]")
    found = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn" and known.match(chr(c))]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in _ranges(found)) or "\\uffff"


def _ranges(points: list[int]) -> list[list[int]]:
    out: list[list[int]] = []
    for c in points:
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return out


def is_word(text: str) -> bool:
    """Letters, with a space before them or not: one piece of the pattern."""
    return text[1:].isalpha() and (text[0] == " " or text[0].isalpha())


def shared_heads(words: list[bytes]) -> list[int]:
    """How many of its first HEAD bytes each word shares with the one before it."""
    heads = np.array([b"", *words], f"S{HEAD}").view(np.uint8).reshape(-1, HEAD)
    apart = heads[1:] != heads[:-1]
    same = np.where(apart.any(axis=1), apart.argmax(axis=1), HEAD)
    size = np.array([0, *map(len, words)])
    return np.minimum(same, np.minimum(size[1:], size[:-1])).tolist()


class ByteBpe:
    """Tables of one vocabulary; ids are in merge order after the 256 bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = _byte_chars()
        vocab = spec["model"]["vocab"]
        raw = {t: bytes(chars[c] for c in t) for t in vocab}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for t, i in vocab.items():
            self.bytes_of[i] = raw[t]
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        self.size = [len(x) for x in self.bytes_of]
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        self.id_of = {raw[t]: i for t, i in vocab.items()}
        self.left, self.right = list(range(size)), list(range(size))
        self.merged: dict[int, int] = {}
        for pair in spec["model"]["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.left[z], self.right[z] = x, y
            self.merged[x << 20 | y] = z
        starts = {t[:n] for t in self.id_of for n in range(len(t) + 1)}
        self.states = {p: k for k, p in enumerate(sorted(starts, key=len))}
        self.path_of = list(self.states)
        self.next: dict[int, int] = {}
        self.longest: list[int | None] = [None] * len(self.path_of)
        self.shorter: dict[int, int] = {}
        self.beside: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.split = regex.compile(SPLIT)
        self.chars = chars
        self.newer = regex.compile(f"[{_newer_letters()}]")
        self.mark = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def _suffix(self, text: bytes) -> int:
        for k in range(len(text)):
            if (t := self.id_of.get(text[k:])) is not None:
                return t
        raise ValueError("no byte token")

    def _step(self, state: int, byte: int) -> int:
        text = self.path_of[state] + bytes((byte,))
        while text not in self.states:
            text = text[1:]
        self.next[state << 8 | byte] = s = self.states[text]
        if self.longest[s] is None:
            self.longest[s] = self._suffix(text)
        return s

    def _apart(self, a: int, b: int) -> bool:
        """Whether the two tokens stay as they are side by side: no merge that would come
        before either was complete crosses the border between them."""
        merged, left, right, limit = self.merged, self.left, self.right, 1 << 30
        while True:
            z = merged.get(a << 20 | b)
            if z is not None and z < limit:
                return False
            if a > b:
                limit = a
                a = right[a]
                if a == limit:
                    limit = b + 1
                    b = left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit = b + 1
                b = left[b]
                if b + 1 == limit:
                    limit = a
                    a = right[a]
                    if a == limit:
                        return True

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not known yet in one walk over their trie."""
        nxt, longest, shorter, size, packed = self.next, self.longest, self.shorter, self.size, self.packed
        beside, done, todo = self.beside, self.known, sorted(words)  # the order of their UTF-8 bytes as well
        if len(beside) > PAIRS:
            beside.clear()
        coded = [text.encode() for text in todo]
        before, states, last = b"", [0], []
        for text, word, keep in zip(todo, coded, shared_heads(coded), strict=True):
            if keep == HEAD:
                most = min(len(word), len(before))
                if word[:most] == before[:most]:
                    keep = most
                else:
                    while word[keep] == before[keep]:
                        keep += 1
            del states[keep + 1 :], last[keep:]
            state = states[keep]
            for i, byte in enumerate(word[keep:], keep):
                try:
                    state = nxt[state << 8 | byte]
                except KeyError:
                    state = self._step(state, byte)
                t = longest[state]
                while (start := i - size[t]) >= 0:
                    pair = last[start] << 20 | t
                    try:
                        if beside[pair]:
                            break
                    except KeyError:
                        beside[pair] = ok = self._apart(last[start], t)
                        if ok:
                            break
                    if t not in shorter:
                        shorter[t] = self._suffix(self.bytes_of[t][1:])
                    t = shorter[t]
                states.append(state)
                last.append(t)
            ids, end = [], len(word) - 1
            while end >= 0:
                t = last[end]
                ids.append(packed[t])
                end -= size[t]
            ids.reverse()
            done[text] = b"".join(ids)
            before = word

    def pieces(self, text: str) -> list[str]:
        """The library's split of a text: by pattern, or by the library itself where its Unicode
        tables may be older than the pattern engine's."""
        if is_word(text):
            return [text]
        if text[-1:] in END and is_word(text[:-1]):
            return [text[:-1], text[-1]]
        if text.isascii() or not self.newer.search(text):
            return self.split.findall(text)
        from tokenizers.pre_tokenizers import ByteLevel

        found = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(text)
        return [bytes(self.chars[c] for c in p).decode() for p, _ in found]

    def _unknown(self, wanted: set[str]) -> set[str]:
        """The wanted keys that neither generation has; those of the old one move to the new."""
        missing = wanted - self.known.keys()
        for k in missing & self.old.keys():
            self.known[k] = self.old[k]
        return missing - self.old.keys() if self.old else missing

    def _learn_runs(self, runs: set[str]) -> None:
        """Ids of the runs that are not known yet; a run of one piece is a word itself."""
        if len(self.known) > CACHE:
            self.known, self.old = {}, self.known
        words, more = set(), {}
        for r in self._unknown(runs):
            if is_word(r):
                words.add(r)
            else:
                p = self.pieces(r)
                words.update(p)
                if len(p) != 1:
                    more[r] = p
        self.learn(self._unknown(words))
        get = self.known.__getitem__
        for r, p in more.items():
            self.known[r] = b"".join(map(get, p))

    def forget(self) -> None:
        """Drop what was learned from texts; the tables stay."""
        self.known.clear()
        self.old.clear()

    def _runs(self, text: str) -> list[str]:
        """Cut before each space that stands between two other characters: no piece of the pattern
        crosses such a place, so the runs can be encoded, and kept, one by one."""
        first, *rest = text.split(" ")
        if first and all(rest) and "\n " not in text and " \n" not in text and not (RARE.search(text) and SPACED.search(text)):
            return [first, *[" " + x for x in rest]]
        return BETWEEN.split(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        parts: list[list] = []
        seen: set[str] = set()
        for text in texts:
            found: list = []
            at = 0
            for m in self.mark.finditer(text) if self.mark and "<" in text else ():
                found.append(self._runs(text[at : m.start()]))
                found.append(array("I", [self.special[m[0]]]).tobytes())
                at = m.end()
            found.append(self._runs(text[at:] if at else text))
            for p in found:
                if isinstance(p, list):
                    seen.update(p)
            parts.append(found)
        self._learn_runs(seen)
        get = self.known.__getitem__
        return [b"".join([p if isinstance(p, bytes) else b"".join(map(get, p)) for p in found]) for found in parts]

    def decode(self, ids: bytes) -> str:
        a = array("I")
        a.frombytes(ids)
        return b"".join(map(self.bytes_of.__getitem__, a)).decode("utf-8", "replace")


def tokenizer(path: str) -> ByteBpe:
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def encode_batches(bpe: ByteBpe, batches):
    """Batches (id, ids_le, decoded) of batches (id, text)."""
    for b in sliced(batches, SLICE):
        ids = bpe.encode(b.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.string())],
            names=["id", "ids_le", "decoded"],
        )


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids_le, decoded): ids as little-endian unsigned 32-bit integers, and the text they decode to."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = tokenizer(path)
        gc.disable()  # no cycles here, and going through the many small objects again and again takes time
        try:
            yield from encode_batches(bpe, batches)
        finally:
            bpe.forget()
            gc.enable()

    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    out = src.mapInArrow(returning(run), f"id {id_type}, ids_le binary, decoded string")
    return out.withColumnRenamed("id", id_col)


def op10_query(docs: DataFrame, path: str) -> DataFrame:
    """Digests of ids and decoded text per document."""
    return encode_decode(docs, path).select(
        "doc_id",
        (F.octet_length("ids_le") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids_le", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def digests(ids: bytes, decoded: str) -> tuple[str, str]:
    """The same digests in plain Python, for tests."""
    return hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

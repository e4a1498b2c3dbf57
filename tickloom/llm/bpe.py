"""Byte-pair encoding by a traversal of the trie of distinct words, and decoding.

The encoding of a text's every prefix ends in one well-defined token. That token is a property of
the prefix alone, so words that begin alike share it: the distinct words of a slice form a trie,
which is walked depth first, and each node gets its last token from the nodes above it. A token may
follow the one before it if no merge across their border would have come first.

Nulls count as empty text. Empty texts give no ids. Repeated rows give equal rows. Other columns
are left out. The vocabulary file is named by its path and read in the tasks.
"""

import hashlib
import json
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame

from tickloom.llm.text import map_texts, once_a_worker, texts, two_columns

# Fixed value: the public pattern that parts text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Bytes, about, of distinct words with their encodings and of pairs of tokens that a task keeps
# before starting anew; what one of either takes beside its characters.
CACHE_BYTES = 96 << 20
_WORD_BYTES, _PAIR_BYTES = 190, 110
_NEVER = 1 << 60


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xAD)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


class Vocabulary:
    """Tokens, merges and special strings of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        words = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.ids = {raw(t): i for t, i in words.items() if t not in self.special}
        size = max([*words.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for token, i in self.ids.items():
            self.bytes[i] = token
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.rank = [-1] * size
        self.parts = [(0, 0)] * size
        self.merge = {}
        for at, pair in enumerate(data["model"]["merges"]):
            left, right = (raw(t) for t in (pair.split(" ") if isinstance(pair, str) else pair))
            a, b, whole = self.ids[left], self.ids[right], self.ids[left + right]
            if self.rank[whole] < 0:
                self.rank[whole], self.parts[whole] = at, (a, b)
            self.merge[a, b] = at
        self.longest = max(map(len, self.ids))
        self._follows, self._stands = {}, {}

    def _unbroken(self, a: int, b: int, until: int) -> bool:
        """No merge across the border of ``a`` and ``b`` comes before ``until`` or before their own."""
        rank, parts, merge = self.rank, self.parts, self.merge
        while True:
            if merge.get((a, b), _NEVER) < until:
                return False
            if rank[a] > rank[b]:
                until, a = rank[a], parts[a][1]
            elif rank[b] >= 0:
                # Of two equal merges the left one is first, so a tie breaks the right token.
                until, b = rank[b] + 1, parts[b][0]
            else:
                return True

    def stands(self, token: int) -> bool:
        """The token's own bytes are encoded as that one token."""
        found = self._stands.get(token)
        if found is None:
            a, b = self.parts[token]
            found = self.rank[token] < 0 or (
                self._unbroken(a, b, self.rank[token]) and self.stands(a) and self.stands(b)
            )
            self._stands[token] = found
        return found

    def follows(self, a: int, b: int) -> bool:
        key = a << 32 | b
        found = self._follows.get(key)
        if found is None:
            found = self._follows[key] = self._unbroken(a, b, _NEVER)
        return found

    def encode_words(self, words: set[bytes]) -> dict[bytes, list[int]]:
        """Encodings of distinct words; sorted order visits their trie depth first."""
        ids, sizes = self.ids, [len(t) for t in self.bytes]
        stands, follows, longest = self.stands, self.follows, self.longest
        standing, following = self._stands.get, self._follows.get  # most are known by then
        path: list[int] = []  # last token of each prefix on the way to the present node
        out, before = {}, b""
        for word in sorted(words):
            shared, most = 0, min(len(word), len(before))
            if word[:most] == before[:most]:
                shared = most
            else:
                while word[shared] == before[shared]:
                    shared += 1
            del path[shared:]
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    token = ids.get(word[start:end])
                    if token is None:
                        continue
                    alone = standing(token)
                    if not (stands(token) if alone is None else alone):
                        continue
                    if start:
                        before_it = path[start - 1]
                        fits = following(before_it << 32 | token)
                        if not (follows(before_it, token) if fits is None else fits):
                            continue
                    path.append(token)
                    break
            found, end = [], len(word)
            while end:
                found.append(path[end - 1])
                end -= sizes[found[-1]]
            out[word] = found[::-1]
            before = word
        return out


def vocabulary(path: str) -> Vocabulary:
    """Parsed once per worker process; what it has found out about pairs goes with each task."""
    return once_a_worker(f"vocabulary {path}", lambda: Vocabulary(path))


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


def _decimals(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


class Encoder:
    """Encodes texts; keeps the encodings of the words seen so far, in the ``form`` that is asked.

    ``odd`` has what a word's ids decode to, where that is not the word.
    """

    def __init__(self, vocabulary: Vocabulary, form: Callable[[list[int]], bytes] = _packed):
        self.vocabulary, self.form = vocabulary, form
        self.split = regex.compile(PATTERN).findall
        special = vocabulary.special
        longest_first = sorted(special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if special else None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}
        self.size = 0
        self.vocabulary._follows.clear()

    def _pieces(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.split(text)
        out = []
        for part in self.special.split(text):
            out += [part] if part in self.vocabulary.special else self.split(part)
        return out

    def encode(self, batch: list[str]) -> list[list[str]]:
        """Each text's words, all of them known by then."""
        if self.size + _PAIR_BYTES * len(self.vocabulary._follows) > CACHE_BYTES:
            self.forget()
        pieces = [self._pieces(t) for t in batch]
        special, known, table = self.vocabulary.special, self.known, self.vocabulary.bytes
        new = {w for w in set().union(*pieces) if w not in known and w not in special}
        coded = self.vocabulary.encode_words({w.encode() for w in new})
        for word in new:
            raw = word.encode()
            ids = coded[raw]
            known[word] = self.form(ids)
            decoded = b"".join(map(table.__getitem__, ids))
            if decoded != raw:
                self.odd[word] = decoded.decode("utf-8", "replace")
            self.size += 6 * len(word) + _WORD_BYTES
        known.update((w, self.form([i])) for w, i in special.items())
        return pieces


def _encode(batch: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
    pieces = encoder.encode([t.decode() for t in texts(batch, "text")])
    of = encoder.known.__getitem__
    found = [np.frombuffer(b"".join(map(of, words)), "<i4") for words in pieces]
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else [], pa.int32()))
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])


def _digest(batch: pa.RecordBatch, encoder: Encoder) -> pa.RecordBatch:
    sizes, ids, decoded = [], [], []
    pieces = encoder.encode([t.decode() for t in texts(batch, "text")])
    of, odd = encoder.known.__getitem__, encoder.odd
    for words in pieces:
        decimals = b",".join(map(of, words))
        sizes.append(decimals.count(b",") + 1 if words else 0)
        ids.append(hashlib.sha256(decimals).hexdigest())
        back = [odd.get(w, w) for w in words] if odd else words
        decoded.append(hashlib.sha256("".join(back).encode()).hexdigest())
    columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of every whole text, as the file's own library would give."""
    rows = two_columns(df, id_col, text_col)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>"
    return map_texts(rows, "text", schema, lambda: partial(_encode, encoder=Encoder(vocabulary(path))))


def decode(df: DataFrame, path: str) -> DataFrame:
    """Adds to the columns of ``encode`` the ``text`` that the ids stand for."""
    schema = f"doc_id {df.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string"

    def run(batches):
        table = vocabulary(path).bytes
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = part.column("ids")
                sizes = pa.compute.fill_null(pa.compute.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                ends = np.cumsum([0, *sizes]).tolist()
                flat = ids.flatten().to_numpy(zero_copy_only=False).tolist()
                raw = (b"".join(map(table.__getitem__, flat[a:b])) for a, b in zip(ends, ends[1:]))
                found = [r.decode("utf-8", "replace") for r in raw]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(found, pa.string())],
                    ["doc_id", "ids", "text"],
                )

    return df.select("doc_id", "ids").mapInArrow(run, schema)


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token count and checksums of the ids and of the decoded text, per row of ``df``.

    Encoded, decoded and digested in one step, so that no ids leave the task. A word's ids are
    turned into decimals and decoded once; a text's are those of its words, joined.
    """
    rows = two_columns(df, id_col, text_col)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(rows, "text", schema, lambda: partial(_digest, encoder=Encoder(vocabulary(path), _decimals)))

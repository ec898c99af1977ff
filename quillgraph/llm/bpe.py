"""Byte-level BPE: an exact backtracking encoder and a table decoder.

Encoding takes, from each position, the longest vocabulary token that an Aho-Corasick automaton finds there and
accepts it if it can stand beside the token before it; otherwise it tries the token's next shorter prefix, and steps
back when none is left. A sequence whose neighbours are all compatible is the one that applying the merges in order
gives. Decoding gathers the bytes of all tokens from one string through a table of offsets.
"""

from __future__ import annotations

import json
import re

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from quillgraph.llm.common import held

#: Fixed value: the pre-tokenizer pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words, with the white space before them, whose ids a worker remembers.
REMEMBER = 600_000
REMEMBER_PIECES = 400_000
#: Pairs of the compatibility table that a worker keeps.
MOST_PAIRS = 400_000
#: These count as white space for re but not for the pattern above.
ODD_SPACE = re.compile("[\x1c-\x1f]")
UNIT = re.compile(r"\s*\S+|\s+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        letters = byte_letters()
        self.to_letters = {b: x for b, x in enumerate(letters)}
        byte = {x: b for b, x in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern = regex.compile(PATTERN)
        # The rank at which a pair merges, and of each token its two halves.
        self.rank: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            pair = vocab[a], vocab[b]
            self.rank[pair[0] << 32 | pair[1]] = r
            self.halves.setdefault(vocab[a + b], pair)
        self.length = {i: len(t) for t, i in vocab.items()}
        usable = {t: i for t, i in vocab.items() if len(t) == 1 or i in self.halves}
        self.shorter: dict[int, int | None] = {}
        for t, i in usable.items():
            self.shorter[i] = next((usable[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in usable), None)
        self.automaton = ahocorasick.Automaton()
        for t, i in usable.items():
            self.automaton.add_word(t, (len(t), i))
        self.automaton.make_automaton()
        self.spines: tuple[dict, dict] = ({}, {})
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.pack = {i: np.uint32(i).tobytes() for i in [*vocab.values(), *self.special.values()]}
        # The decoder's table: all tokens' bytes, and where each begins.
        most = max([*vocab.values(), *self.special.values()])
        raw = [b""] * (most + 1)
        for t, i in vocab.items():
            raw[i] = bytes(byte[x] for x in t) if all(x in byte for x in t) else t.encode()
        for t, i in self.special.items():
            raw[i] = t.encode()
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.offset = np.concatenate(([0], np.cumsum([len(x) for x in raw])))

    def _spine(self, token: int, side: int) -> tuple[list[int], list[float]]:
        """The tokens that stand at the right (side 1) or left (0) end of a token while it is built, from itself back to
        a byte, and the rank at which each is absorbed."""
        found = self.spines[side].get(token)
        if found is None:
            tokens, gone = [token], [float("inf")]
            while tokens[-1] in self.halves:
                pair = self.halves[tokens[-1]]
                gone.append(self.rank[pair[0] << 32 | pair[1]])
                tokens.append(pair[side])
            found = self.spines[side][token] = tokens, [*gone, -1]
        return found

    def compatible(self, a: int, b: int) -> bool:
        """Whether a and b can be neighbours: no merge across their border comes before both its parts are absorbed.

        Walks back in time through the pairs that stood at the border together. Equal merges apply from the left, so
        one across the border precedes an equal one on its right.
        """
        key = a << 32 | b
        found = self.pairs.get(key)
        if found is not None:
            return found
        get = self.rank.get
        xs, gone_x = self._spine(a, 1)
        ys, gone_y = self._spine(b, 0)
        i = j = 0
        found = True
        while i < len(xs) and j < len(ys):
            r = get(xs[i] << 32 | ys[j])
            if r is not None and r < gone_x[i] and r <= gone_y[j]:
                found = False
                break
            if gone_x[i + 1] > gone_y[j + 1]:
                i += 1
            else:
                j += 1
        if len(self.pairs) < MOST_PAIRS:
            self.pairs[key] = found
        return found

    def piece(self, text: str) -> list[int]:
        """The ids of one piece, given in the vocabulary's letters."""
        greedy = [token for _, (_, token) in self.automaton.iter_long(text)]
        last = greedy[0]
        for token in greedy[1:]:
            if not self.compatible(last, token):
                break
            last = token
        else:
            return greedy
        n = len(text)
        longest = [0] * n
        for end, (size, token) in self.automaton.iter(text):
            longest[end - size + 1] = token
        fits = [True] * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            end = at + self.length[token]
            if fits[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                if at < n:
                    token = longest[at]
                continue
            shorter = self.shorter[token]
            if shorter is None:  # nothing can start here: step back
                fits[at] = False
                token = out.pop()
                at -= self.length[token]
            else:
                token = shorter
        return out

    def _ids(self, text: str) -> bytes:
        known, out = self.pieces, []
        for p in self.pattern.findall(text):
            x = known.get(p)
            if x is None:
                x = b"".join([self.pack[i] for i in self.piece(p.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.to_letters))])
                if len(known) < REMEMBER_PIECES:
                    known[p] = x
            out.append(x)
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        if ODD_SPACE.search(text):
            return self._ids(text)
        units, words = UNIT.findall(text), self.words
        out = list(map(words.get, units))
        if None in out:
            new = {u: self._ids(u) for u in {u for u, x in zip(units, out) if x is None}}
            out = [new[u] if x is None else x for u, x in zip(units, out)]
            if len(words) < REMEMBER:
                words.update(new)
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers; special tokens in the text become their ids."""
        if not text:
            return b""
        if self.split_special is None or not self.split_special.search(text):
            return self._plain(text)
        return b"".join(self.pack[self.special[p]] if p in self.special else self._plain(p) for p in self.split_special.split(text))

    def decode(self, ids: bytes | None) -> str:
        """The text of packed ids; bytes that aren't UTF-8 become replacement characters."""
        i = np.frombuffer(ids or b"", np.uint32)
        begin, size = self.offset[i], self.offset[i.astype(np.int64) + 1] - self.offset[i]
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        return self.bytes[at].tobytes().decode("utf-8", "replace")


def load(path: str) -> Bpe:
    """One instance for each worker and file."""
    return held(("bpe", path), lambda: Bpe(path), 180)


def bpe_encode(text: Column, path: str) -> Column:
    """Packed ids of a text column. Null and empty texts have no ids (an empty binary)."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([load(path).encode(x) for x in texts], dtype=object)

    return F.pandas_udf(run, BinaryType())(text)


def bpe_decode(ids: Column, path: str) -> Column:
    """The texts of packed ids; null ids give an empty text."""

    def run(blobs: pd.Series) -> pd.Series:
        return pd.Series([load(path).decode(x) for x in blobs], dtype=object)

    return F.pandas_udf(run, StringType())(ids)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (packed) and ``decoded`` for each row.

    One row for each input row, repeated rows and null ids included; null and empty texts have no ids and decode to
    an empty text; an empty table gives no rows; other columns are ignored.
    """
    ids = docs.select(F.col(id_col).alias("doc_id"), bpe_encode(F.col(text_col), path).alias("ids"))
    return ids.withColumn("decoded", bpe_decode(F.col("ids"), path))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))

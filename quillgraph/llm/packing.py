"""Packing: first-fit decreasing with a tournament tree, run by itself in random groups of documents."""

from __future__ import annotations

import os
import re
import zlib
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm.common import held

SEQUENCE = 4096
#: Pieces of a group, by an estimate of four bytes an id; more leave less padding, fewer are quicker.
GROUP_ROWS = 4096
ID_BYTES = 4
#: The id that ends each document.
END = 2
#: Words whose ids a worker remembers: less time against some 190 bytes each.
REMEMBER = 1_000_000
HOT = 20_000
#: Texts whose unknown words are looked up together.
TOGETHER = 128
#: Python counts these as white space, the tokenizer's patterns don't.
ODD_SPACE = re.compile("[\x1c-\x1f]")


class WordIds:
    """Packed ids of a text, word by word: the tokenizer drops white space and joins nothing across it."""

    def __init__(self, path: str, remember: int = REMEMBER):
        self.remember = remember
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.mark_id, self.mark = next((i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if "<" in t.content)
        self.hot: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _look_up(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, many to a call: a special token between them, which the tokenizer cuts out first, parts the ids."""
        plain = [w for w in words if "<" not in w]
        found = {w: np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint32).tobytes() for w in words if "<" in w}
        parts = [plain[at : at + 256] for at in range(0, len(plain), 256)]
        for some, e in zip(parts, self.tokenizer.encode_batch_fast([self.mark.join(x) for x in parts], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            blob, cuts = ids.tobytes(), np.flatnonzero(ids == self.mark_id) * 4
            begin = [0, *(cuts + 4).tolist()]
            found.update({w: blob[a:b] for w, a, b in zip(some, begin, [*cuts.tolist(), len(blob)])})
        return found

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of several texts, whose unknown words are looked up together.

        The words met first are in a small table of their own: most words of a text are, and it stays in the cache.
        """
        hot, rest = self.hot.get, self.words.get
        out: list = [None] * len(texts)
        unknown: set[str] = set()
        waiting = []
        for i, text in enumerate(texts):
            if not text:
                out[i] = b""
                continue
            if ODD_SPACE.search(text):
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()
                continue
            words = text.split()
            ids = [rest(w) if x is None else x for w, x in zip(words, map(hot, words))]
            if None in ids:
                unknown.update([w for w, x in zip(words, ids) if x is None])
                waiting.append((i, words, ids))
            else:
                out[i] = b"".join(ids)
        if waiting:
            new = self._look_up(list(unknown))
            for i, words, ids in waiting:
                out[i] = b"".join([new[w] if x is None else x for w, x in zip(words, ids)])
            if len(self.hot) < HOT:
                self.hot.update(new)
            elif len(self.words) < self.remember:
                self.words.update(new)
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


def load(path: str, remember: int = REMEMBER) -> WordIds:
    """One instance for each worker and file."""
    return held(("packing", path, remember), lambda: WordIds(path, remember), 40 + remember // 6000)


class Bins:
    """Bins of equal size in a tournament tree of free room: each inner node holds the most room below it."""

    def __init__(self, most: int, size: int):
        self.leaves = 1 << max(0, (most - 1).bit_length())
        self.room = [size] * (2 * self.leaves)

    def place(self, length: int) -> int:
        """Put a piece in the first bin with room for it, and return that bin."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < length:
                at += 1
        leaf = at
        room[at] -= length
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return leaf - self.leaves


def first_fit_decreasing(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """The bin of each piece and its place in the bin; pieces go from the longest to the shortest."""
    bins, fill = Bins(len(lengths), size), {}
    where, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = where[i] = bins.place(lengths[i])
        offset[i] = fill.get(b, 0)
        fill[b] = offset[i] + lengths[i]
    return where, offset


def _cut(batches, path: str, size: int, keep_ids: bool, remember: int):
    """Pieces of each document: whole sequences, then the rest. ``copy`` numbers equal rows, so that these part."""
    copies: dict[int, int] = {}
    for p in batches:
        rows = []
        texts = p["text"].tolist()
        encoded = (x for at in range(0, len(texts), TOGETHER) for x in load(path, remember).encode_all(texts[at : at + TOGETHER]))
        for doc, ids in zip(p["doc_id"].astype(object).where(p["doc_id"].notna(), None), encoded):
            ids += np.uint32(END).tobytes()
            n = len(ids) // 4
            pieces = [ids[4 * at : 4 * (at + size)] for at in range(0, n, size)]
            check = [zlib.crc32(x) for x in pieces]
            row = hash((doc, *check))
            copy = copies[row] = copies.get(row, -1) + 1
            rows += [(doc, size * k, len(x) // 4, c, n, copy, x if keep_ids else None) for k, (x, c) in enumerate(zip(pieces, check))]
        yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "copy", "ids"]).astype({"doc_id": "Int64"})


def _pack(pdf: pd.DataFrame, size: int) -> pd.DataFrame:
    """Full pieces are sequences by themselves; the others go through the tree."""
    pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable", ignore_index=True)
    length = pdf["length"].to_numpy()
    full = int((length == size).sum())
    where, offset = first_fit_decreasing(length[full:].tolist(), size)
    where = np.concatenate((np.arange(full), full + np.array(where, np.int64)))
    fill = pdf["length"].groupby(where).transform("sum")
    padded = np.where(fill & (fill - 1), size, fill)
    return pdf.assign(sequence_id=pdf["group"].astype("int64") * (1 << 32) + where, offset=np.concatenate((np.zeros(full, np.int64), np.array(offset, np.int64))), sequence_tokens=fill, sequence_length=padded).drop(columns="group")


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, group_rows: int = GROUP_ROWS, keep_ids: bool = False, remember: int = REMEMBER) -> DataFrame:
    """Pack the ids of all texts, each followed by the end id, into sequences of at most ``size`` ids.

    A document longer than a sequence gives full pieces and a rest; pieces meet in random groups of about
    ``group_rows`` pieces, each packed by itself. Returns a row for each piece: ``doc_id``, ``start`` and
    ``length`` in the document's ids, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``,
    ``sequence_tokens`` (the sequence's ids), ``sequence_length`` (padded to ``size``, except at a power of two) and
    ``ids`` (packed; null unless ``keep_ids``). ``remember`` bounds the words whose ids a worker keeps.

    Null and empty texts are the end id alone. Repeated rows and rows with a null id are packed like any other, and equal
    rows spread over the groups; ties in length go by id and start; an empty table gives no rows; other columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows, size_bytes = base.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    groups = max(1, round((rows + (size_bytes or 0) / (ID_BYTES * size)) / group_rows))
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    cut = base.mapInPandas(partial(_cut, path=path, size=size, keep_ids=keep_ids, remember=remember), f"{kinds}, copy long, ids binary")
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "copy"), F.lit(groups)).cast("int")).drop("copy")
    return dealt.groupBy("group").applyInPandas(partial(_pack, size=size), f"{kinds}, sequence_id long, offset long, sequence_tokens long, sequence_length long, ids binary")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
    return out.drop("ids")

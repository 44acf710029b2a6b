"""Cross-tokenizer alignment: pointer jumping over two token streams, corpus-wide counts of linked ids.

* Tokens: a text with one space put before it is encoded by a byte-level BPE file (A) and by a piece model (B). Both streams
  cover the same bytes, so a token is a byte range. A text that is null or empty, or whose joined A or B bytes differ from
  space + text (say by normalisation), has no tokens: zeros and an empty digest.
* Groups by pointer jumping: every token points to its farthest-right overlapping token (equal ends: the B token, a token
  that nothing overlaps further right points to itself). Replacing each pointer by its target's pointer doubles the reach, so
  the whole batch settles in a logarithmic number of gathers on its terminal tokens; tokens of one terminal are one group.
  Texts of a batch lie end to end: both streams end with each text, so no group crosses.
* Links: the overlapping A-B occurrences. Each A token overlaps the B token that holds its last byte; each B token that ends
  inside an A token overlaps that one. These are all pairs, each once.
* Corpus counts: documents are dealt into chunks of about ``CHUNK`` bytes of text in their input partition. A chunk holds its
  distinct id pairs with the number of its documents that link them, so a pair crosses the shuffle once a chunk, however
  frequent it is. The counts are summed by pair, the highest of an A id is a table of at most one row an A id, and
  each chunk gets the counts of its own pairs back. Nothing is sampled, cut or sent to the driver.

Repeated rows count as documents of their own; null ids keep their rows; an empty table gives an empty result; a
table's further columns are never read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensio.session import materialize

TOKENIZERS = "/opt/tokenizers"
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text whose documents share a chunk of pair counts, and bytes that are aligned at once.
CHUNK, BATCH = 16 << 20, 1 << 20
#: Fixed value: the pattern by which the byte-level file splits a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose classes every regex library agrees on; other texts take the slower library.
_PLAIN = re.compile("[\t\n\r -~¡-ɏ‐-‧‰-⁞]*")
_LONG = 500
_DOC = "kind int, chunk long, doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, cells binary, pairs array<long>, docs array<long>"
_OUT = "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_loaded: dict[tuple[str, str], Tokenizers] = {}


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both encoders of a worker with the byte strings of their ids."""

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._byte_file, self._exact, self._fast = byte_file, None, None
        with open(byte_file, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet, vocab = byte_alphabet(), spec["model"]["vocab"]
        special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if t not in special}
        first = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        self.bytes_a = [first.get(i, b"") for i in range(max(first) + 1)]
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        ids = [vocab[m.replace(" ", "")] for m in merges]
        ordered = all(a < b for a, b in zip(ids, ids[1:], strict=False))  # ids tell the order of merges
        if ordered and spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["pre_tokenizer"]["add_prefix_space"] and not spec["normalizer"]:
            import tiktoken

            self._fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._piece = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        p = self._piece
        self.bytes_b = [bytes([int(p.id_to_piece(i)[1:-1], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode() for i in range(p.vocab_size())]
        self.n_a, self.n_b = len(self.bytes_a), len(self.bytes_b)
        self.flat_a, self.start_a, self.len_a = _flat(self.bytes_a)
        self.flat_b, self.start_b, self.len_b = _flat(self.bytes_b)
        self.digits = _digits([f"{i}," for i in range(self.n_a)] + [f"{i}|" for i in range(self.n_a)] + [f"{i}," for i in range(self.n_b)] + [f"{i};" for i in range(self.n_b)])

    def encode_a(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts, special tokens' strings as plain text. Both libraries give the same ids; the fast one serves plain texts."""
        out: list[np.ndarray | None] = [None] * len(texts)
        slow = []
        for i, text in enumerate(texts):
            if self._fast is None or not _PLAIN.fullmatch(text) or _has_long_run(text):
                slow.append(i)
            else:
                out[i] = self._fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        if slow and self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_file(self._byte_file)
            self._exact.encode_special_tokens = True
        for i in slow:
            out[i] = np.array(self._exact.encode(texts[i], add_special_tokens=False).ids, dtype=np.int64)
        return out  # type: ignore[return-value]

    def encode_b(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.int64) for ids in self._piece.encode(texts, num_threads=1)]


def _has_long_run(text: str) -> bool:
    """A word or a run of white space of more than ``_LONG`` characters may be there (merging those is quadratic in the fast library)."""
    words = text.split()
    return max(map(len, words), default=0) > _LONG or len(text) - sum(map(len, words)) > len(words) + _LONG


def _flat(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lens = np.array([len(t) for t in tokens], dtype=np.int64)
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(lens) - lens, lens


def _digits(strings: list[str]) -> np.ndarray:
    width = max(map(len, strings))
    return np.frombuffer("".join(s.ljust(width, "\0") for s in strings).encode(), dtype=np.uint8).reshape(-1, width)


def load(byte_file: str, piece_file: str) -> Tokenizers:
    """The worker's tokenizers, read once."""
    if (byte_file, piece_file) not in _loaded:
        _loaded[byte_file, piece_file] = Tokenizers(byte_file, piece_file)
    return _loaded[byte_file, piece_file]


def _same_bytes(ids: list[np.ndarray], raws: list[bytes], flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """For every text: do the tokens' bytes, joined, equal its bytes?"""
    ok = np.array([int(length[i].sum()) == len(r) for i, r in zip(ids, raws, strict=True)], dtype=bool)
    at = np.flatnonzero(ok)
    if len(at):
        tokens = np.concatenate([ids[i] for i in at])
        lens = length[tokens]
        begin = np.cumsum(lens) - lens
        joined = flat[np.arange(int(lens.sum())) + np.repeat(start[tokens] - begin, lens)]
        differs = joined != np.frombuffer(b"".join(raws[i] for i in at), dtype=np.uint8)
        ends = np.cumsum([len(raws[i]) for i in at])
        wrong = np.concatenate(([0], np.cumsum(differs)))
        ok[at] = wrong[ends] == wrong[np.concatenate(([0], ends[:-1]))]
    return ok


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token (A's, then B's) the terminal it converges to; and the last overlapping token of each A and each B token."""
    n = len(ends_a)
    over_a, over_b = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    pointer = np.concatenate([n + over_a, np.where(ends_a[over_b] > ends_b, over_b, n + np.arange(len(ends_b)))])
    while True:
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            return pointer, over_a, over_b
        pointer = further


def align_batch(tok: Tokenizers, texts: list[str | None]) -> list[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
    """Per text: n_a, n_b, n_groups, n_links, digest, distinct linked id pairs (``a * n_b_ids + b``, ascending), their occurrences."""
    none = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))
    out: list[tuple] = [none] * len(texts)
    at = [i for i, t in enumerate(texts) if t]
    if not at:
        return out
    raws = [b" " + texts[i].encode("utf-8", "surrogatepass") for i in at]
    ids_a, ids_b = tok.encode_a([" " + texts[i] for i in at]), tok.encode_b([texts[i] for i in at])
    ok = _same_bytes(ids_a, raws, tok.flat_a, tok.start_a, tok.len_a) & _same_bytes(ids_b, raws, tok.flat_b, tok.start_b, tok.len_b)
    keep = np.flatnonzero(ok)
    if not len(keep):
        return out
    a, b = np.concatenate([ids_a[i] for i in keep]), np.concatenate([ids_b[i] for i in keep])
    doc_a, doc_b = (np.repeat(np.arange(len(keep)), [len(x[i]) for i in keep]) for x in (ids_a, ids_b))
    ends_a, ends_b = np.cumsum(tok.len_a[a]), np.cumsum(tok.len_b[b])
    pointer, over_a, over_b = terminals(ends_a, ends_b)
    n = len(a)
    closing = pointer[n:] == np.arange(n, n + len(b))
    rank = np.cumsum(closing) - 1
    group_a, group_b = rank[pointer[:n] - n], rank[pointer[n:] - n]
    n_groups = int(rank[-1]) + 1
    shut_a = ends_a == ends_b[over_a]  # last A token of its group
    inside = np.flatnonzero(~closing & (ends_a[over_b] != ends_b))
    pair = np.concatenate([a * tok.n_b + b[over_a], a[over_b[inside]] * tok.n_b + b[inside]])
    of = np.concatenate([doc_a, doc_b[inside]])
    key, times = np.unique((of << 40) | pair, return_counts=True)
    cuts = np.searchsorted(key >> 40, np.arange(len(keep) + 1))
    per_a, per_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    upto_a, before_b = np.cumsum(per_a), np.cumsum(per_b) - per_b
    order = np.empty(n + len(b), dtype=np.int64)
    order[np.arange(n) + before_b[group_a]] = a + tok.n_a * shut_a
    order[np.arange(len(b)) + upto_a[group_b]] = 2 * tok.n_a + b + tok.n_b * closing
    written = tok.digits[order]
    used = np.cumsum((written != 0).sum(axis=1))
    flat = written.ravel()
    body = flat[flat != 0].tobytes()
    last = np.cumsum(np.bincount(doc_a, minlength=len(keep)) + np.bincount(doc_b, minlength=len(keep))) - 1
    groups = np.bincount(doc_b[closing], minlength=len(keep))
    begin = 0
    for k, i in enumerate(keep):
        end = int(used[last[k]])
        digest = hashlib.sha256(body[begin : end - 1]).hexdigest()
        begin = end
        na, nb, ng = len(ids_a[i]), len(ids_b[i]), int(groups[k])
        part = slice(cuts[k], cuts[k + 1])
        out[at[i]] = (na, nb, ng, na + nb - ng, digest, key[part] & ((1 << 40) - 1), times[part])
    return out


def _pack(places: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending places in a chunk's list as steps, and occurrences; compressed."""
    import zstandard

    steps = np.diff(places, prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(steps.astype("<u4").tobytes() + times.astype("<u4").tobytes())


def _unpack(cells: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(cells), dtype="<u4")
    half = len(flat) // 2
    return np.cumsum(flat[:half].astype(np.int64)), flat[half:].astype(np.int64)


def _in_batches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list]]:
    """Runs of documents of about ``BATCH`` characters, across Arrow batches."""
    ids, texts, size = [], [], 0
    for pdf in batches:
        for i, t in zip(pdf["doc_id"].tolist(), pdf["text"], strict=True):
            ids.append(i)
            texts.append(t)
            size += len(t or "")
            if size >= BATCH or len(ids) >= 20_000:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _encode(byte_file: str, piece_file: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, number, size, held = TaskContext.get().partitionId(), 0, 0, []

        def close() -> pd.DataFrame:
            """The chunk's documents, their pairs as places in the chunk's list, and one row with that list."""
            chunk = (task << 24) + number
            lens = [len(r[6]) for _, r in held]
            pairs, places, docs = np.unique(np.concatenate([r[6] for _, r in held]), return_inverse=True, return_counts=True)
            ends = np.cumsum(lens)
            rows = [(0, chunk, i, *r[:5], _pack(places[e - n : e], r[7]) if n else None, None, None) for (i, r), n, e in zip(held, lens, ends, strict=True)]
            rows.append((1, chunk, None, None, None, None, None, None, None, pairs, docs))
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _DOC.split(", ")])
            return frame.astype({c: "Int64" for c in ("n_a", "n_b", "n_groups", "n_links")})

        tok = None
        for ids, texts in _in_batches(batches):
            tok = tok or load(byte_file, piece_file)
            for i, t, r in zip(ids, texts, align_batch(tok, texts), strict=True):
                held.append((i, (*r[:5], None, *r[5:])))
                size += len(t or "") + 64
            if size >= CHUNK:
                yield close()
                number, size, held = number + 1, 0, []
        if held:
            yield close()

    return run


def _count_links(docs: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """n_best and count_sum of a chunk's documents; ``counts`` has the chunk's pairs once each."""
    counts = counts.sort_values("pair")
    total, best = counts["total"].to_numpy(np.int64), counts["best"].to_numpy(np.int64)
    n_best, count_sum = [], []
    for cells in docs["cells"]:
        places, times = _unpack(cells) if cells is not None else (np.empty(0, np.int64), np.empty(0, np.int64))
        n_best.append(int(times @ best[places]))
        count_sum.append(int(times @ total[places]))
    docs = docs.assign(n_best=n_best, count_sum=count_sum)
    return docs[[c.split()[0] for c in _OUT.split(", ")]]


def aligned_documents(
    docs: DataFrame, folder: str = TOKENIZERS, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    files = f"{folder}/{byte_file}", f"{folder}/{piece_file}"
    thin = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))  # ids as text: nulls beside them stay exact
    coded = materialize(thin.mapInPandas(_encode(*files), _DOC), "aligned")
    listed = coded.where("kind = 1").select(F.col("chunk").alias("home"), F.explode(F.arrays_zip("pairs", "docs")).alias("x")).select("home", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    width = F.lit(load(*files).n_b)
    totals = materialize(listed.groupBy("pair").agg(F.sum("docs").alias("total")).withColumn("a", F.floor(F.col("pair") / width)), "pair-counts")
    highest = totals.groupBy("a").agg(F.max("total").alias("highest"))  # one row an A id
    judged = totals.join(F.broadcast(highest), "a").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    back = listed.select("home", "pair").join(judged, "pair").select("home", "pair", "total", "best")
    own = coded.where("kind = 0").select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "cells")
    linked = own.groupBy("chunk").cogroup(back.groupBy("home")).applyInPandas(_count_links, _OUT)
    return linked.withColumn("doc_id", F.col("doc_id").cast("long")).withColumnRenamed("doc_id", id_col)


def alignment_pairs(
    docs: DataFrame, folder: str = TOKENIZERS, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The corpus-wide table of linked ids: ``a_id``, ``b_id``, ``documents`` and whether that is the A id's ``best``."""
    files = f"{folder}/{byte_file}", f"{folder}/{piece_file}"
    thin = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))  # ids as text: nulls beside them stay exact
    coded = materialize(thin.mapInPandas(_encode(*files), _DOC), "aligned").where("kind = 1")
    width = load(*files).n_b
    pairs = coded.select(F.explode(F.arrays_zip("pairs", "docs")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("documents"))
    pairs = materialize(pairs.selectExpr(f"cast(pair div {width} as int) as a_id", f"cast(pair % {width} as int) as b_id", "documents"), "pair-counts")
    highest = pairs.groupBy("a_id").agg(F.max("documents").alias("highest"))
    return pairs.join(F.broadcast(highest), "a_id").select("a_id", "b_id", "documents", (F.col("documents") == F.col("highest")).alias("best"))

"""BPE encoding and decoding with a pair occurrence index.

A task works through its partition in chunks of bounded size. The distinct
pre-tokens of a chunk lie end to end in one symbol array with links between
neighbours. An index maps each adjacent pair that has a merge rank to all
its positions; active ranks are applied in ascending order, each to all its
positions at once, and the lists of the pairs that a merge creates are
updated. Texts are then put together from their pre-tokens' ids.

The vocabulary is a byte-level BPE file (``tokenizers`` JSON); its path is
a parameter, resolved on the executors. Special tokens in a text are
matched as the ``tokenizers`` library does by default. Null texts count as
empty, empty texts have no ids. Long texts are cut only at places where
pre-tokens end anyway, so results do not depend on the chunk size.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dbtelemetry.llm import common

# Fixed by the vocabulary's kind: byte-level pre-token pattern.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
VOCABULARY = "byte_bpe_50k.json"
CHUNK_CHARS = 3_000_000
CACHE_WORDS = 250_000
CACHE_CHARS = 48


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Merge ranks and token bytes of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        chars = byte_chars()
        back = {c: b for b, c in enumerate(chars)}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max(max(vocab.values()), *added.values(), 0) + 1
        self.bytes = [b""] * self.size
        for token, i in vocab.items():
            self.bytes[i] = bytes(back[c] for c in token) if token not in added else b""
        for token, i in added.items():
            self.bytes[i] = token.encode()
        self.added = added
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        self.byte_id = np.array([vocab[c] for c in chars], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int32)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        keys = self.left.astype(np.int64) * self.size + self.right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = np.append(keys[order], np.iinfo(np.int64).max), np.append(order, -1).astype(np.int32)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of symbols, -1 where there is none."""
        key = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each non-empty word, as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        starts = np.concatenate(([0], ends[:-1]))
        sym = self.byte_id[data]
        after = np.arange(1, len(data) + 1, dtype=np.int64)
        after[ends - 1] = -1
        before = np.arange(-1, len(data) - 1, dtype=np.int64)
        before[starts] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            rank = self.rank_of(sym[at], sym[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            begin = 0
            for end in [*cuts.tolist(), len(at)]:
                r = int(rank[begin])
                if r in index:
                    index[r].append(at[begin:end])
                else:
                    index[r] = [at[begin:end]]
                    heapq.heappush(active, r)
                begin = end

        add(np.flatnonzero(after >= 0))
        while active:
            r = heapq.heappop(active)
            at = index.pop(r)
            at = at[0] if len(at) == 1 else np.unique(np.concatenate(at))
            a, b = self.left[r], self.right[r]
            # A position is spent if a symbol there has since been merged away.
            at = at[(sym[at] == a) & (after[at] >= 0)]
            nxt = after[at]
            live = sym[nxt] == b
            at, nxt = at[live], nxt[live]
            if not len(at):
                continue
            if a == b and len(at) > 1:
                # Runs such as "aaaa": every second position from a run's start.
                i = np.arange(len(at))
                joins = np.concatenate(([False], nxt[:-1] == at[1:]))
                first = np.maximum.accumulate(np.where(joins, 0, i))
                even = (i - first) % 2 == 0
                at, nxt = at[even], nxt[even]
            sym[at] = self.merged[r]
            sym[nxt] = -1
            beyond = after[nxt]
            after[at] = beyond
            inner = beyond >= 0
            before[beyond[inner]] = at[inner]
            prior = before[at]
            touched = np.concatenate((prior[prior >= 0], at[inner]))
            add(np.unique(touched) if len(touched) > 1 else touched)
        alive = sym >= 0
        flat = sym[alive].astype("<u4").tobytes()
        stop = np.cumsum(np.add.reduceat(alive.astype(np.int64), starts)) * 4
        out, begin = [], 0
        for end in stop.tolist():
            out.append(flat[begin:end])
            begin = end
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of a sequence of ids, special tokens included; ids outside the vocabulary are skipped."""
        ids = ids[ids < self.size]
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str | None = None) -> Vocabulary:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return Vocabulary(path)


_WORDS = regex.compile(PATTERN)
_SAFE_CUT = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})")


class Encoder:
    """Encodes texts; remembers the ids of short pre-tokens from chunk to chunk."""

    def __init__(self, vocab: Vocabulary, chunk_chars: int = CHUNK_CHARS):
        self.vocab, self.chunk = vocab, chunk_chars
        self.known: dict[str, bytes] = {}

    def _parts(self, text: str) -> Iterator[str | int]:
        """Runs of plain text and ids of special tokens, in order; runs are cut near the chunk size."""
        at = 0
        for m in self.vocab.special.finditer(text) if self.vocab.special else ():
            yield from self._cut(text[at:m.start()])
            yield self.vocab.added[m.group()]
            at = m.end()
        yield from self._cut(text[at:] if at else text)

    def _cut(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > self.chunk and (m := _SAFE_CUT.search(text, at + self.chunk)):
            yield text[at:m.start()]
            at = m.start()
        if at < len(text):
            yield text[at:] if at else text

    def encode(self, texts: list[str]) -> list[bytes]:
        done: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str] | int]] = []
        size = 0
        for i, text in enumerate(texts):
            for part in self._parts(text):
                if isinstance(part, int):
                    held.append((i, part))
                    continue
                held.append((i, _WORDS.findall(part)))
                size += len(part)
                if size >= self.chunk:
                    self._flush(held, done)
                    held, size = [], 0
        self._flush(held, done)
        return [b"".join(d) for d in done]

    def _flush(self, held: list, done: list[list[bytes]]) -> None:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        fresh: set[str] = set()
        for _, part in held:
            if not isinstance(part, int):
                fresh.update(part)
        words = [w for w in fresh if w not in known]
        codes = dict(zip(words, self.vocab.encode_words([w.encode() for w in words]), strict=True))
        known.update(codes)
        for i, part in held:
            done[i].append(part.to_bytes(4, "little") if isinstance(part, int) else b"".join(map(known.__getitem__, part)))
        for w in words:
            if len(w) > CACHE_CHARS:
                del known[w]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           decoded: bool = False, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit integers).

    With ``decoded`` the text that the ids decode to is added. Rows stay in
    their partitions; nothing is shuffled.
    """
    rows = with_ids(common.texts(docs, id_col, text_col), "text", path, decoded, chunk_chars)
    return rows.select("doc_id", "n_tokens", "ids", *(["decoded"] if decoded else []))


def with_ids(docs: DataFrame, text_col: str = "text", path: str | None = None, decoded: bool = False,
             chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``docs`` with the columns ``n_tokens`` and ``ids``, and ``decoded`` if asked for."""

    def start():
        vocab = vocabulary(path)
        encoder = Encoder(vocab, chunk_chars)

        def compute(texts):
            ids = encoder.encode(texts)
            out = {"n_tokens": [len(i) // 4 for i in ids], "ids": ids}
            if decoded:
                out["decoded"] = [vocab.decode(np.frombuffer(i, "<u4")) for i in ids]
            return out

        return compute

    fields = [("n_tokens", T.LongType()), ("ids", T.BinaryType())] + ([("decoded", T.StringType())] if decoded else [])
    return common.with_columns(docs, start, fields, text_col, chunk_chars)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``doc_id, text`` of rows holding ids as ``encode`` writes them (null: empty)."""
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            texts = [vocab.decode(np.frombuffer(i, "<u4")) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return rows.mapInArrow(run, "doc_id long, text string")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document's token count and the digests of its ids and of the text they decode to."""
    return digests(encode(common.table(spark, sf_dir, "documents"), decoded=True))

"""Byte-level BPE: exact merges in linear time from longest matches and backtracking."""

from __future__ import annotations

import base64
import hashlib
import itertools
import weakref
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from .common import python_ready, read_table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
_CACHED_PAIRS, _CACHED_PIECES, _CACHED_LENGTH = 1_000_000, 400_000, 64
# Ids of a text are written and decoded in runs of so many.
_RUN = 65536


class _Pieces(dict):
    """Ids of the matches of the pattern, each encoded when it is first asked for."""

    def __init__(self, encoder: Encoder):
        # No cycle: an encoder that is dropped goes at once, with all it remembers.
        self.encoder = weakref.proxy(encoder)

    def __missing__(self, match: str) -> tuple[int, ...]:
        ids = tuple(self.encoder.encode_piece(match.encode().decode("latin-1")))
        if len(match) <= _CACHED_LENGTH:
            if len(self) >= _CACHED_PIECES:
                self.clear()
            self[match] = ids
        return ids


class Encoder:
    """Ranks of a tiktoken file, applied to one match of the pattern at a time.

    Bytes are handled as Latin-1 text, which the automaton can search. `encode_piece` takes
    the longest token at each place; where it cannot stand next to the token before it, the
    next shorter prefix is tried, and failing all, the token before is taken back. A place
    that failed once is never tried again, so the work is linear in the piece. Two tokens
    may stand side by side if merging their bytes by rank gives back these two. Short pieces ask
    the automaton for the longest token only at the places that are reached, long ones for all at once.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.pattern = regex.compile(pattern)
        self.rank = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.text = {rank: token for token, rank in self.rank.items()}
        # Lists by rank: looked up for every id of every text.
        raw = {rank: token for token, rank in ranks.items()}
        places = range(max(raw, default=-1) + 1)
        self.raw = [raw.get(rank) for rank in places]
        self.size = [len(token or b"") for token in self.raw]
        self.written = [str(rank).encode() for rank in places]
        self.longest = max(self.size, default=1)
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.pairs: dict[int, bool] = {}
        self.pieces = _Pieces(self)
        self._split_tokens()
        self.pairs.clear()
        self.automaton = ahocorasick.Automaton()
        self.usable = {t: rank for rank, t in self.text.items() if len(t) == 1 or self.halves[rank] != (rank, rank)}
        for token, rank in self.usable.items():
            self.automaton.add_word(token, (len(token), rank))
        self.automaton.make_automaton()
        self.shorter = [self._prefix(self.text[rank]) if rank in self.text else None for rank in places]

    def _split_tokens(self) -> None:
        """The last merge that makes each token; a token no merge makes is its own half."""
        for rank in sorted(self.text):
            token = self.text[rank]
            self.halves[rank] = (rank, rank)
            for cut in range(len(token) - 1, 0, -1):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is None or right is None or left >= rank or right >= rank:
                    continue
                if self._compatible(left, right):
                    self.halves[rank] = (left, right)
                    self.merged[left, right] = rank
                    break

    def _prefix(self, token: str) -> int | None:
        for cut in range(len(token) - 1, 0, -1):
            rank = self.rank.get(token[:cut])
            if rank is not None and (cut == 1 or self.halves[rank] != (rank, rank)):
                return rank
        return None

    def _compatible(self, left: int, right: int) -> bool:
        """Undo merges at the border, latest first; none may join the border earlier than that."""
        limit = len(self.rank) + len(self.text) + 1
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and joined < limit:
                return False
            from_left = left > right
            for side in (from_left, not from_left):
                if side and self.halves[left][1] != left:
                    limit, left = left, self.halves[left][1]
                    break
                if not side and self.halves[right][0] != right:
                    limit, right = right + 1, self.halves[right][0]
                    break
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        found = self.pairs.get(pair)
        if found is None:
            if len(self.pairs) >= _CACHED_PAIRS:
                self.pairs.clear()
            found = self.pairs[pair] = self._compatible(left, right)
        return found

    def _longest(self, piece: str) -> list[int | None]:
        """The longest token at each place."""
        longest: list[int | None] = [None] * len(piece)
        best = [0] * len(piece)
        for end, (size, rank) in self.automaton.iter(piece):
            start = end - size + 1
            if size > best[start]:
                best[start], longest[start] = size, rank
        return longest

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one match, given as Latin-1 text."""
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        length = len(piece)
        longest = self._longest(piece) if length > _CACHED_LENGTH else None
        sizes, shorter, pairs, usable, reach = self.size, self.shorter, self.pairs, self.usable, self.automaton.longest_prefix
        open_at = bytearray(b"\x01") * (length + 1)
        ids: list[int] = []
        at, before, token, new = 0, None, None, True
        while at < length:
            if new:
                new = False
                if longest:
                    token = longest[at]
                else:
                    rest = piece[at:]
                    size = reach(rest)
                    token = usable.get(rest[:size])
                    while token is None and size > 1:
                        size -= 1
                        token = usable.get(rest[:size])
            if token is None:
                # Nothing fits here: this place is closed, and the token before gives way.
                if before is None:
                    raise ValueError("the vocabulary lacks a byte of the text")
                open_at[at] = 0
                token = ids.pop()
                at -= sizes[token]
                token, before = shorter[token], ids[-1] if ids else None
                continue
            end = at + sizes[token]
            fits = open_at[end]
            if fits and before is not None:
                fits = pairs.get(before << 32 | token)
                if fits is None:
                    fits = self.compatible(before, token)
            if fits:
                ids.append(token)
                before, at, new = token, end, True
            else:
                token = shorter[token]
        return ids

    def encode(self, text: str) -> Iterator[Sequence[int]]:
        """Ids of each match, in order. The dictionary works out those it lacks, so that known ones cost one look."""
        return map(self.pieces.__getitem__, self.pattern.findall(text))

    def write(self, ids: Sequence[int]) -> bytes:
        written = self.written
        return b",".join([written[i] for i in ids])

    def decode(self, ids: Sequence[int]) -> bytes:
        raw = self.raw
        return b"".join([raw[i] for i in ids])


def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=1)
def encoder(path: str = RANKS) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(read_ranks(path))


def encode_digests(text: str | None, bpe: Encoder) -> tuple[list[int], str, str]:
    """Ids, digest of the ids and digest of the bytes decoded from them, a run of ids at a time."""
    ids = list(itertools.chain.from_iterable(bpe.encode(text or "")))
    of_ids, of_bytes = hashlib.sha256(), hashlib.sha256()
    for at in range(0, len(ids), _RUN):
        run = ids[at : at + _RUN]
        of_ids.update((b"," if at else b"") + bpe.write(run))
        of_bytes.update(bpe.decode(run))
    return ids, of_ids.hexdigest(), of_bytes.hexdigest()


def tokenizer(path: str = RANKS, with_ids: bool = False):
    """A column function text -> struct(n_tokens, ids_sha256, decoded_sha256[, ids])."""
    kind = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    @pandas_udf(kind)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path)
        for texts in batches:
            columns: dict[str, list] = {name.split()[0]: [] for name in kind.split(", ")}
            for text in texts:
                ids, of_ids, of_bytes = encode_digests(text, bpe)
                for values, value in zip(columns.values(), (len(ids), of_ids, of_bytes, ids)):
                    values.append(value)
            yield pd.DataFrame(columns)

    return apply


def encode_documents(docs: DataFrame, path: str = RANKS, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) of every row, whole texts.

    Null is encoded as the empty text: no token, and digests of nothing. Repeated rows are
    repeated; other columns are ignored, whatever their names.
    """
    python_ready(docs.sparkSession)
    found = docs.select("doc_id", tokenizer(path, with_ids)("text").alias("found"))
    return found.select("doc_id", F.col("found.*"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"))

"""Byte-level BPE by prefix dynamic programming.

For each prefix of a piece there is exactly one token that can be the last of the prefix's encoding:
the token t of length k such that t is valid after the last token of the prefix k bytes shorter. Two
tokens are valid side by side if encoding their bytes gives back just these two. So one token per
prefix is stored; the encoding is read off from the end. Appending goes on from the stored tokens and
is exact, and after an edit only the prefixes near it are computed again: an entry depends on no more
entries before it than the longest token has bytes.

A piece that is itself a token is that token, as in the usual rank encoders.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain, groupby

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Memo, stable, stretches

#: Characters of texts whose new matches are encoded together, and ids in a frame.
GROUP, FRAME = 1 << 20, 1 << 19
#: Bytes of a match from which on prefixes don't keep their encodings.
LONG = 200


class PrefixTable:
    """The last token of each prefix of `data`."""

    def __init__(self, model: ByteBPE, data: bytes = b""):
        self.model, self.data, self.last = model, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.model.fill(self.data, self.last)

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replaces data[start:end]; returns how many entries were computed."""
        tail, old = self.data[end:], self.last[end:]
        self.data = self.data[:start] + new + tail
        del self.last[start:]
        same = 0
        for k in range(start + 1, len(self.data) + 1):
            self.last.append(self.model._last(self.data, k, self.last))
            place = k - 1 - start - len(new)
            same = same + 1 if place >= 0 and self.last[-1] == old[place] else 0
            if same == self.model.longest:
                self.last += old[place + 1 :]
                return k - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        whole = self.model.ranks.get(self.data)
        return [whole] if whole is not None else self.model.read_off(self.last)


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.endings = {token[k:] for token in ranks for k in range(len(token))}
        self.matches = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.matches.add_word(token.decode("latin-1"), (rank, len(token)))
        self.matches.make_automaton()
        self._splits: dict[int, tuple[int, int] | None] = {}
        self._edges: dict[tuple[int, int], list[tuple[bytes, int, float]]] = {}
        self._pairs: dict[int, bool] = {}
        # Ids of a match, 32 bits each.
        self.known = Memo(64 << 20)
        self.packed = {rank: array("i", [rank]).tobytes() for rank in self.tokens}
        self.decimals = {rank: str(rank) for rank in self.tokens}

    def merged(self, data: bytes, down_to: int = 1) -> list[int]:
        """The defining encoding: join the neighbours of lowest rank, leftmost first, until nothing
        is left to join or `down_to` parts are."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            ranked = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            best = min((r for r in ranked if r is not None), default=None)
            if best is None:
                break
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _split_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merging joins last to make `token`; None for a byte or for a token
        that merging never makes."""
        if token not in self._splits:
            parts = self.merged(self.tokens[token], 2)
            self._splits[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._splits[token]

    def _is_valid(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self._split_of(token) is not None

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int, float]]:
        """The tokens that stand at the last (side 1) or first (side 0) end of `token` while it is
        merged: bytes, the rank that makes it and the rank that takes it up."""
        key = (token, side)
        if key not in self._edges:
            found, until, split = [], float("inf"), (token, token)
            while split is not None:
                part = split[side]
                data = self.tokens[part]
                found.append((data, part if len(data) > 1 else -1, until))
                until, split = part, self._split_of(part)
            self._edges[key] = found
        return self._edges[key]

    def _fit(self, one: int, two: int) -> bool:
        """Whether merging never joins anything across the two: no pair of their edges makes a token
        of a rank at which both still stand. Of equal ranks the leftmost goes first."""
        ranks = self.ranks
        left, right = iter(self._edge(one, 1)), iter(self._edge(two, 0))
        a, made_a, until_a = next(left)
        b, made_b, until_b = next(right)
        while True:
            rank = ranks.get(a + b)
            if rank is not None and made_a < rank > made_b:
                if rank < until_a and rank <= until_b:
                    return False
            # Back in time: what was made last is taken apart; of equal ranks that is the right one.
            if made_a > made_b:
                a, made_a, until_a = next(left)
            elif made_b >= 0:
                b, made_b, until_b = next(right)
            else:
                return True

    def _follows(self, one: int, token: int) -> bool:
        """Whether `token` can stand after the token `one`, or first if that is -1; kept for pairs
        seen before."""
        pair = one << 32 | token
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) > 200_000:
                self._pairs.clear()
            known = self._is_valid(token) and (one < 0 or self._fit(one, token))
            self._pairs[pair] = known
        return known

    def fill(self, data: bytes, last: list[int]) -> None:
        """Goes on with `last` up to the end of `data`. One scan finds the tokens that end at each
        place, the longest first; those that start before what is new are among them."""
        base = max(0, len(last) + 1 - self.longest)
        pairs, follows = self._pairs, self._follows
        place = len(last) - base
        for at, (token, size) in self.matches.iter(data[base:].decode("latin-1")):
            if at != place:
                if at > place:
                    raise ValueError("the vocabulary lacks a byte")
                continue
            start = base + at + 1 - size
            one = last[start - 1] if start else -1
            fits = pairs.get(one << 32 | token)
            if fits is None:
                fits = follows(one, token)
            if fits:
                last.append(token)
                place += 1
        if len(last) != len(data):
            raise ValueError("the vocabulary lacks a byte")

    def read_off(self, last: list[int]) -> list[int]:
        """The encoding that a prefix table says, from its end."""
        found, end = [], len(last)
        while end:
            found.append(last[end - 1])
            end -= len(self.tokens[found[-1]])
        return found[::-1]

    def _last(self, data: bytes, end: int, last: list[int]) -> int:
        """One entry of a prefix table, for edits."""
        candidates = []
        for start in range(end - 1, -1, -1):
            ending = data[start:end]
            if ending not in self.endings:
                break
            token = self.ranks.get(ending)
            if token is not None:
                candidates.append((start, token))
        for start, token in reversed(candidates):
            if self._follows(last[start - 1] if start else -1, token):
                return token
        raise ValueError("the vocabulary lacks a byte")

    def encode_piece(self, piece: str) -> list[int]:
        data = piece.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.fill(data, last)
        return self.read_off(last)

    def learn(self, matches: list[str]) -> None:
        """Encodes matches. In the order of their bytes each goes on from the table of the one before,
        cut back to the prefix that they share: its entries don't depend on what follows. Beside a
        prefix's last token stands the prefix's whole encoding."""
        pairs, follows, packed, scan = self._pairs, self._follows, self.packed, self.matches.iter
        before, last, paths = "", [], []
        # Bytes as characters of the same numbers have the same order.
        for data, match in sorted((match.encode().decode("latin-1"), match) for match in matches):
            if len(data) > LONG:
                self.known[match] = array("i", self.encode_piece(match)).tobytes()
                continue
            place = 0
            for one, two in zip(before, data, strict=False):
                if one != two:
                    break
                place += 1
            del last[place:], paths[place:]
            for at, (token, size) in scan(data):
                # Places filled before, and shorter tokens at the place filled last.
                if at < place:
                    continue
                start = at + 1 - size
                one = last[start - 1] if start else -1
                fits = pairs.get(one << 32 | token)
                if fits or (fits is None and follows(one, token)):
                    last.append(token)
                    paths.append(paths[start - 1] + packed[token] if start else packed[token])
                    place += 1
            if len(last) != len(data):
                raise ValueError("the vocabulary lacks a byte")
            before = data
            whole = self.ranks.get(match.encode())
            self.known[match] = paths[-1] if whole is None else packed[whole]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(ids.tolist() for _, ids in self.encoded([text])))

    def encoded(self, texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the text, ids of a stretch of it): at least one for each text, in order. What is
        new in about GROUP characters is encoded together, each distinct match once."""
        held: list[tuple[int, list[str]]] = []
        size = 0
        for number, text in enumerate(texts):
            for stretch in stretches(text):
                held.append((number, self.pattern.findall(stretch)))
                size += len(stretch)
                if size > GROUP:
                    yield from self._looked_up(held)
                    held, size = [], 0
        yield from self._looked_up(held)

    def _looked_up(self, held: list[tuple[int, list[str]]]) -> Iterator[tuple[int, np.ndarray]]:
        new = self.known.missing(chain.from_iterable(matches for _, matches in held))
        self.learn(new)
        for number, matches in held:
            packed = b"".join(map(self.known.__getitem__, matches))
            yield number, np.frombuffer(packed, np.int32)
        self.known.forget_long(new)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def edit(self, text: str, ids: list[int], start: int, end: int, new: str) -> tuple[str, list[int]]:
        """The text with text[start:end] replaced, and its ids: only what lies between the nearest
        stable places before and after the edit is encoded again."""
        left = next((at for at in range(start - 1, 0, -1) if stable(text, at)), 0)
        right = next((at for at in range(end + 1, len(text)) if stable(text, at)), len(text))
        changed = text[:start] + new + text[end:]
        middle = self.encode(text[left:start] + new + text[end:right])
        before = self._count(ids, len(text[:left].encode()))
        after = self._count(ids[::-1], len(text[right:].encode()))
        return changed, ids[:before] + middle + ids[len(ids) - after :]

    def append(self, text: str, ids: list[int], more: str) -> tuple[str, list[int]]:
        return self.edit(text, ids, len(text), len(text), more)

    def _count(self, ids: list[int], n_bytes: int) -> int:
        """How many of the ids cover the first (of the reversed: last) `n_bytes` bytes."""
        count = 0
        while n_bytes > 0:
            n_bytes -= len(self.tokens[ids[count]])
            count += 1
        return count


@cache
def model(name: str) -> ByteBPE:
    """`name` is a rank file of `public_tokenizers`."""
    import public_tokenizers

    ranks = {}
    with open(public_tokenizers.path(name), "rb") as file:
        for line in file:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ByteBPE(ranks, public_tokenizers.PATTERN)


RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_and_decode(docs: DataFrame, name: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per row of `docs`: the digests of the
    decimal ids joined by commas and of the bytes that the ids decode to. With `with_ids` also `ids`
    (array of int).

    A null text is empty; no text is cut. A null doc_id stays null, repeated rows have rows of their own, an
    empty table gives an empty result and columns besides doc_id and text aren't read. Texts are dealt
    with by stretches, and frames have a bounded number of ids or are one text's.
    """
    kind = RESULT + (", ids array<int>" if with_ids else "")
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]

    @F.pandas_udf(kind)
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = model(name)
        for batch in batches:
            rows, held = [], 0
            for _, stretch_ids in groupby(bpe.encoded(batch), key=lambda found: found[0]):
                n, listed, decoded, kept = 0, hashlib.sha256(), hashlib.sha256(), []
                for _, packed in stretch_ids:
                    ids = packed.tolist()
                    text = ",".join(map(bpe.decimals.__getitem__, ids))
                    listed.update(f",{text}".encode() if n and ids else text.encode())
                    decoded.update(bpe.decode(ids))
                    n += len(ids)
                    if with_ids:
                        kept.append(packed)
                whole = [np.concatenate(kept)] if with_ids else []
                rows.append((n, listed.hexdigest(), decoded.hexdigest(), *whole))
                held += n * with_ids
                if held > FRAME:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=names)

    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", coded(text).alias("c")).select("doc_id", "c.*")

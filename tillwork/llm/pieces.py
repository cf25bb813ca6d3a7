"""SentencePiece encoding with seeded merge-dropout, and decoding.

Encoding follows the model's merges from an agenda of adjacent pairs, best score first and leftmost
among equals.  Each candidate that comes up is skipped with a given probability, decided by a keyed
hash of its place in the document: the same seed and document give the same pieces anywhere, another
document or a repeat of a word gives others.  What is remembered of a word is how it is cut for a
given pattern of skips, whatever the key.  Decoding gives back every text exactly, whichever merges
were skipped.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import query, table

DROPOUT = 0.1
SEED = 7
#: cuts of words that one worker keeps; beyond it all are forgotten and made again as they come up
REMEMBERED = 400_000
#: draws for each character: a part of n characters has fewer than 3 * n candidates
DRAWS = 4
#: characters of the longest chunk that is remembered
LONG = 64
#: a chunk is remembered once it comes up again; this many marks, a power of two, tell which came up
MARKS = 1 << 20


def _skips(key: int, n: int, limit: int) -> np.ndarray:
    """Of the ``n * DRAWS`` draws of ``n`` characters, the numbers of those that skip a candidate.

    The draws are halves of the numbers of a splitmix generator that begins at ``key``.
    """
    out = [np.zeros(0, np.int64)]
    for lo in range(0, n * DRAWS // 2, 1 << 15):
        h = np.arange(lo + 1, min(n * DRAWS // 2, lo + (1 << 15)) + 1, dtype=np.uint64)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += np.uint64(key)
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        out.append(np.flatnonzero(h.view(np.uint32) <= np.uint32(limit - 1)) + 2 * lo)
    return np.concatenate(out)


def _laid_out(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first .. first + count - 1`` of each row, end to end."""
    ends = np.cumsum(count)
    return np.repeat(first - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)


def _codes(texts: Iterable[str]) -> np.ndarray:
    """The code points of all texts, end to end."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")


def _at(rows: array, index: np.ndarray) -> np.ndarray:
    return np.frombuffer(rows, np.int64)[index]


#: parts that work through their agendas together
SIDE_BY_SIDE = 1 << 14
#: rows and characters (or ids) that are worked on together; a longer document goes alone
TOGETHER = 200, 1_000_000
#: the cost of a pair that does not merge
NEVER = np.iinfo(np.int32).max


class Codec:
    """Encodes and decodes with the pieces of one model.

    ``pieces``: (text, score) for each id; ``byte_ids``: the id of each of the 256 byte pieces;
    ``skip``: ids that are neither.  The model has a byte fallback and marks a space by U+2581; a
    literal U+2581 is spelt in bytes, so that it is not taken for a space.
    """

    def __init__(
        self,
        pieces: tuple[tuple[str, float], ...],
        byte_ids: tuple[int, ...],
        skip: frozenset[int],
        dropout: float = 0.0,
    ):
        self.limit = int(dropout * (1 << 32))
        special = skip | set(byte_ids)
        # texts have plain spaces here; the mark only exists inside the model
        texts = [p.replace("▁", " ") for p, _ in pieces]
        self.ids = {t: i for i, t in enumerate(texts) if i not in special and t}
        # equal scores share a place: the leftmost candidate goes first
        costs = {cost: place for place, cost in enumerate(sorted({-pieces[i][1] for i in self.ids.values()}))}
        self.rank = {t: costs[-pieces[i][1]] for t, i in self.ids.items() if len(t) > 1}
        self.inside = {t[k : k + 2] for t in self.rank for k in range(len(t) - 1)}
        self.bytes = [t.encode() for t in texts]
        for b, i in enumerate(byte_ids):
            self.bytes[i] = bytes([b])
        for i in skip:
            self.bytes[i] = b""
        self.byte_ids = byte_ids
        # no merge crosses two neighbours that no piece has side by side; most often that is at a
        # space after something else, and at a line end
        inner = any(" " in t.lstrip(" ") for t in self.ids)
        line = "" if any("\n" in t for t in self.rank) else r"\n"
        self.chunk = re.compile(r"[\s\S]+" if inner else rf" *[^ {line}]+| +" + (r"|\n" if line else ""))
        self.marks, self.marked = bytearray(MARKS), 0
        self._pairs()
        self._forget()

    def _pairs(self) -> None:
        """Symbols are the characters and pieces that merges know, numbered from 1; 0 is any other character."""
        symbols = sorted({c for t in self.rank for c in t} | {t for t in self.ids if len(t) == 1}) + list(self.rank)
        number = {t: k + 1 for k, t in enumerate(symbols)}
        self.symbol = np.zeros(0x110000, np.int64)
        for t, k in number.items():
            if len(t) == 1:
                self.symbol[ord(t)] = k
        self.cost = np.array([NEVER, *[self.rank.get(t, NEVER) for t in symbols]], np.int32)
        self.id_of = np.array([-1, *[self.ids.get(t, -1) for t in symbols]], np.int64)
        made = {
            (number[t[:k]] << 32) + number[t[k:]]: number[t]
            for t in self.rank
            for k in range(1, len(t))
            if t[:k] in number and t[k:] in number
        }
        inner = sorted((number[t[0]] << 32) + number[t[1]] for t in self.inside)
        self.inner = np.array([*inner, np.iinfo(np.int64).max], np.int64)
        self.pair = np.array([*sorted(made), np.iinfo(np.int64).max], np.int64)
        self.makes = np.array([*[made[k] for k in sorted(made)], 0], np.int64)

    def _forget(self) -> None:
        """Forget all chunks and cuts.

        A chunk is the numbers of its parts' cuts without a skip.  A cut is a part and the
        candidates skipped in it; it holds until the part's next skip, where another takes over.
        Chunk 0 and cut 0 stand for what is not remembered.
        """
        self.kept = 0
        self.chunks: dict[str, int] = {}
        self.chunk_ends, self.chunk_cuts = array("q", [0, 1]), array("q", [0])
        self.plain: dict[str, int] = {}
        self.cuts: list[tuple[str, tuple[int, ...]]] = [("", ())]
        # of each cut: characters, candidates, ends of its ids and of the cuts after it
        self.width, self.tested = array("q", [0]), array("q", [0])
        self.id_ends, self.next_ends = array("q", [0, 0]), array("q", [0, 0])
        self.ids_of, self.next = array("q"), array("q")

    def spans(self, text: str, key: int) -> list[str]:
        """The pieces of ``text`` after all merges that are not skipped."""
        return self._merged(text, self._draws([text], [key])[1].tobytes())[0]

    def _draws(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the draws that skip, and a byte for each draw, of all texts end to end."""
        skips, at = [np.zeros(0, np.int64)], 0
        for text, key in zip(texts, keys, strict=True):
            if self.limit:
                skips.append(_skips(key, len(text), self.limit) + at)
            at += len(text) * DRAWS
        skip = np.concatenate(skips)
        draws = np.zeros(at, np.uint8)
        draws[skip] = 1
        return skip, draws

    def _merged(self, text: str, skips: bytes) -> tuple[list[str], int]:
        """The pieces of ``text`` and the number of candidates that came up.

        The candidate that comes up as number t is skipped if ``skips[t]`` is 1.  A candidate is a number made of its piece's place in the order and where it
        begins.  It is out of date unless the two symbols that begin there now are as long as that
        piece.
        """
        rank, n, tested = self.rank, len(text), 0
        width = n + 1  # lengths and begins are below it
        square = width * width
        stop = list(range(1, n + 1))  # the end of the symbol that begins here; 0 once it is merged
        before = list(range(-1, n))  # the begin of the symbol that ends here
        agenda = [r * square + i * width + 2 for i in range(n - 1) if (r := rank.get(text[i : i + 2])) is not None]
        heapify(agenda)
        while agenda:
            candidate = heappop(agenda)
            start, length = divmod(candidate % square, width)
            mid = stop[start]
            if not mid or mid == n:
                continue
            end = stop[mid]
            if end - start != length:
                continue
            tested += 1
            if skips[tested - 1]:
                continue
            stop[start], stop[mid] = end, 0
            before[end] = start
            if start:
                left = before[start]
                if (r := rank.get(text[left:end])) is not None:
                    heappush(agenda, r * square + left * width + end - left)
            if end < n:
                right = stop[end]
                if (r := rank.get(text[start:right])) is not None:
                    heappush(agenda, r * square + start * width + right - start)
        out, at = [], 0
        while at < n:
            out.append(text[at : stop[at]])
            at = stop[at]
        return out, tested

    def _ids(self, pieces: list[str]) -> list[int]:
        out = []
        for piece in pieces:
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            else:
                out += [self.byte_ids[b] for b in piece.encode()]
        return out

    def _together(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The symbols that pairs of symbols merge to, 0 for none."""
        key = (a << 32) + b
        at = np.searchsorted(self.pair, key)
        return np.where(self.pair[at] == key, self.makes[at], 0)

    def _merged_all(self, codes: np.ndarray, size: np.ndarray, base: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, ...]:
        """What ``_merged`` says of many parts: ids end to end, ids of each, candidates of each.

        The parts lie end to end in ``codes``, code points, and their draws begin at ``base``.  All
        work through their agendas side by side, one candidate a turn; those of more than ``LONG``
        characters go alone and have no candidates here.
        """
        begin = np.cumsum(size) - size
        tested = np.zeros(len(size), np.int64)
        order, ids, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        most = 4
        while most < 2 * LONG:
            all_such = np.flatnonzero((size <= most) & (size > (most // 2 if most > 4 else 0)))
            for lo in range(0, len(all_such), SIDE_BY_SIDE):
                among = all_such[lo : lo + SIDE_BY_SIDE]
                left, t = self._turns(codes, begin[among], size[among], most, base[among], draws)
                tested[among] = t
                symbol_ids, times = self._spelt(codes, *left)
                order.append(among)
                ids.append(symbol_ids)
                counts.append(np.bincount(left[0], weights=times, minlength=len(among)).astype(np.int64))
            most *= 2
        for i in np.flatnonzero(size > LONG).tolist():
            part = codes[begin[i] : begin[i] + size[i]].tobytes().decode("utf-32-le")
            pieces = self._merged(part, draws[base[i] : base[i] + DRAWS * size[i]].tobytes())[0]
            order.append(np.array([i]))
            ids.append(np.array(self._ids(pieces), np.int64))
            counts.append(np.array([len(ids[-1])]))
        among, count = np.concatenate(order), np.concatenate(counts)
        first, n_ids = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        first[among], n_ids[among] = np.cumsum(count) - count, count
        return np.concatenate(ids)[_laid_out(first, n_ids)], n_ids, tested

    def _turns(
        self, codes: np.ndarray, begin: np.ndarray, size: np.ndarray, most: int, base: np.ndarray, draws: np.ndarray
    ) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        """The symbols left of each part (part, place in ``codes``, symbol), and its candidates.

        A part is a row with an empty place at both ends; places are numbered through all rows.
        """
        rows, width = len(begin), most + 2
        place = np.arange(width) - 1
        inside = (place >= 0) & (place < size[:, None])
        at = np.where(inside, begin[:, None] + place, 0)
        symbol = np.where(inside, self.symbol[codes[at]], 0).ravel()
        made = np.zeros(rows * width, np.int64)
        made[:-1] = self._together(symbol[:-1], symbol[1:])
        cost = self.cost[made]
        table = cost.reshape(rows, width)
        after, before = np.arange(rows * width) + 1, np.arange(rows * width) - 1
        is_left = inside.ravel()
        tested, going = np.zeros(rows, np.int64), np.arange(rows)
        while len(going):
            best = table[going].argmin(axis=1)
            here = going * width + best
            open_ = cost[here] < NEVER
            going, here = going[open_], here[open_]
            skipped = draws[base[going] + tested[going]] > 0
            tested[going] += 1
            cost[here[skipped]] = NEVER
            here = here[~skipped]
            right = after[here]
            end = after[right]
            symbol[here] = made[here]
            is_left[right], cost[right] = False, NEVER
            after[here], before[end] = end, here
            left = before[here]
            made[here] = self._together(symbol[here], symbol[end])
            made[left] = self._together(symbol[left], symbol[here])
            cost[here], cost[left] = self.cost[made[here]], self.cost[made[left]]
        kept = np.flatnonzero(is_left)
        return (kept // width, at.ravel()[kept], symbol[kept]), tested

    def _spelt(self, codes: np.ndarray, part: np.ndarray, at: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of symbols, and how many each has: characters without an id are spelt in bytes."""
        ids = self.id_of[symbol]
        times = np.ones(len(ids), np.int64)
        rare = np.flatnonzero(ids < 0)
        spelt = [[self.byte_ids[b] for b in chr(c).encode()] for c in codes[at[rare]].tolist()]
        times[rare] = [len(one) for one in spelt]
        ids = np.repeat(ids, times)
        ids[ids < 0] = list(chain.from_iterable(spelt))
        return ids, times

    def _fill(self) -> None:
        """Work out the cuts that have a number and nothing else yet."""
        new = self.cuts[len(self.width) :]
        if not new:
            return
        size = np.array([len(part) for part, _ in new], np.int64)
        base = (np.cumsum(size) - size) * DRAWS
        draws = np.zeros(int(size.sum()) * DRAWS, np.uint8)
        n_skips = np.array([len(skips) for _, skips in new])
        draws[np.repeat(base, n_skips) + np.fromiter(chain.from_iterable(s for _, s in new), np.int64)] = 1
        ids, n_ids, tested = self._merged_all(_codes(part for part, _ in new), size, base, draws)
        self.width.frombytes(size.tobytes())
        self.tested.frombytes(tested.tobytes())
        self.id_ends.frombytes((np.cumsum(n_ids) + len(self.ids_of)).tobytes())
        self.next_ends.frombytes((np.cumsum(tested) + len(self.next)).tobytes())
        self.ids_of.frombytes(ids.tobytes())
        self.next.frombytes(np.full(int(tested.sum()), -1, np.int64).tobytes())
        self.kept += len(new)

    def _chunk(self, chunk: str) -> int:
        """The number of a chunk without one; 0 if it is too long or not known to have come up before."""
        if len(chunk) > LONG:
            return 0
        mark = hash(chunk) & (MARKS - 1)
        if not self.marks[mark]:
            if 2 * self.marked > MARKS:
                self.marks, self.marked = bytearray(MARKS), 0
            self.marks[mark] = 1
            self.marked += 1
            return 0
        for part in self._parts(chunk):
            if part not in self.plain:
                self.plain[part] = len(self.cuts)
                self.cuts.append((part, ()))
            self.chunk_cuts.append(self.plain[part])
        self.chunk_ends.append(len(self.chunk_cuts))
        self.chunks[chunk] = len(self.chunk_ends) - 2
        self.kept += 1
        return self.chunks[chunk]

    def _after(self, cut: np.ndarray, t: np.ndarray) -> np.ndarray:
        """The cuts that take over where candidate ``t`` of each ``cut`` is skipped."""
        at = _at(self.next_ends, cut) + t
        new = _at(self.next, at)
        if (new < 0).any():
            places, some = np.unique(np.where(new < 0, at, -1), return_index=True)
            for place, i in zip(places.tolist(), some.tolist(), strict=True):
                if place >= 0:
                    part, skips = self.cuts[cut[i]]
                    self.next[place] = len(self.cuts)
                    self.cuts.append((part, (*skips, int(t[i]))))
            self._fill()
            new = _at(self.next, at)
        return new

    def _parts(self, chunk: str) -> list[str]:
        inside, cuts = self.inside, [0]
        cuts += [i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in inside]
        return [chunk[a:b] for a, b in pairwise([*cuts, len(chunk)])]

    def encode(self, text: str, key: int = 0) -> bytes:
        """Little-endian unsigned 32-bit ids; an empty text has none."""
        return self.encode_all([text], [key])[0].tobytes()

    def encode_all(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and where the ids of each end.

        The draws of a candidate are those of its part's place in the text.  All parts go from skip
        to skip together.
        """
        if self.kept > REMEMBERED:
            self._forget()
        texts = [" " + text if text else "" for text in texts]
        found = [self.chunk.findall(text) for text in texts]
        known = self.chunks.get
        chunks = list(chain.from_iterable(found))
        chunk = np.array([known(c) or self._chunk(c) for c in chunks], np.int64)
        self._fill()
        first = _at(self.chunk_ends, chunk)
        n_parts = _at(self.chunk_ends, chunk + 1) - first
        cut = _at(self.chunk_cuts, _laid_out(first, n_parts))
        width = _at(self.width, cut)
        anew, once = np.flatnonzero(cut == 0), np.flatnonzero(chunk == 0).tolist()
        width[anew] = [len(chunks[i]) for i in once]
        begin = (np.cumsum(width) - width) * DRAWS
        skip, draws = self._draws(texts, keys)
        skip = np.append(skip, np.iinfo(np.int64).max)
        own, own_n = self._anew([chunks[i] for i in once], begin[anew], draws)
        going, upcoming = np.arange(len(cut)), np.searchsorted(skip, begin)
        while len(going):
            t = skip[upcoming[going]] - begin[going]
            hit = t < _at(self.tested, cut[going])
            going, t = going[hit], t[hit]
            cut[going] = self._after(cut[going], t)
            upcoming[going] += 1
        first = _at(self.id_ends, cut)
        n_ids = _at(self.id_ends, cut + 1) - first
        first[anew], n_ids[anew] = np.cumsum(own_n) - own_n + len(self.ids_of), own_n
        ids = np.concatenate([np.array(self.ids_of), own])[_laid_out(first, n_ids)].astype("<u4")
        parts_before = np.concatenate([[0], np.cumsum(n_parts)])[np.cumsum([len(f) for f in found], dtype=np.int64)]
        return ids, np.concatenate([[0], np.cumsum(n_ids)])[parts_before]

    def _anew(self, chunks: list[str], begin: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks that are not remembered, by the draws from ``begin`` on, and how many each has."""
        if not chunks:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes = _codes(chunks)
        chunk_size = np.array([len(chunk) for chunk in chunks], np.int64)
        chunk_at = np.cumsum(chunk_size) - chunk_size
        pair = (self.symbol[codes[:-1]] << 32) + self.symbol[codes[1:]]
        is_first = np.append(True, self.inner[np.searchsorted(self.inner, pair)] != pair)
        is_first[chunk_at] = True
        part_at = np.flatnonzero(is_first)
        n_parts = np.add.reduceat(is_first.astype(np.int64), chunk_at)
        base = part_at * DRAWS + np.repeat(begin - chunk_at * DRAWS, n_parts)
        ids, n_ids, _ = self._merged_all(codes, np.diff(part_at, append=len(codes)), base, draws)
        return ids, np.add.reduceat(n_ids, np.cumsum(n_parts) - n_parts)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))[1:].decode()


@lru_cache(maxsize=1)
def _codec(parts: tuple, dropout: float) -> Codec:
    return Codec(*parts, dropout=dropout)


def model_parts(path: str) -> tuple:
    """What a codec needs of a SentencePiece model of the merge kind, read on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    byte_ids = tuple(i for i in ids if model.is_byte(i))
    skip = frozenset(i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in ids), byte_ids, skip


def _key(seed: int, doc_id: int | None, text: str) -> int:
    """The key of a document; one without an id has that of its text."""
    name = doc_id if doc_id is not None else f"text {xxhash.xxh64_hexdigest(text.encode())}"
    return xxhash.xxh64_intdigest(f"{seed}:{name}")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A few documents at a time: their ids are far larger than their text."""
    values = batch.column(1)
    sizes = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    ends = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        full = np.searchsorted(ends, TOGETHER[1] + (ends[start - 1] if start else 0), "right")
        end = min(start + TOGETHER[0], max(start + 1, int(full)))
        yield batch.slice(start, end - start)
        start = end


def _mapped(docs: DataFrame, codec: tuple, make: Callable[..., list[pa.Array]], schema: str) -> DataFrame:
    """``make`` gets the codec, doc_ids and values of the second column of some rows and returns new columns.

    ``codec``: the arguments of ``_codec``, which a task asks for once.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _codec(*codec)
        for batch in batches:
            for small in _slices(batch):
                made = make(own, small.column(0).to_pylist(), small.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([small.column(0), *made], ["doc_id", *names])

    return docs.mapInArrow(run, f"doc_id long, {schema}")


def encoded(docs: DataFrame, parts: tuple, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """(doc_id, ids) for each row of ``docs`` (doc_id, text); other columns are left behind.

    A null text has null ids, an empty one none.  Rows with the same doc_id and text get the same
    ids.
    """

    def some(codec: Codec, doc_ids: list, texts: list) -> list[pa.Array]:
        keys = [_key(seed, i, t or "") for i, t in zip(doc_ids, texts, strict=True)]
        ids, ends = codec.encode_all([t or "" for t in texts], keys)
        missing = pa.array([t is None for t in texts])
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        return [pa.ListArray.from_arrays(offsets, pa.array(ids.view("<i4")), mask=missing)]

    return _mapped(docs.select(F.col("doc_id").cast("long"), "text"), (parts, dropout), some, "ids array<int>")


def decoded(docs: DataFrame, parts: tuple) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): the text that was encoded, null for null ids."""

    def some(codec: Codec, _: list, ids: list) -> list[pa.Array]:
        texts = [None if one is None else codec.decode(np.array(one, "<u4").tobytes()) for one in ids]
        return [pa.array(texts, pa.string())]

    return _mapped(docs.select(F.col("doc_id").cast("long"), "ids"), (parts, 0.0), some, "text string")


def round_trip(docs: DataFrame, parts: tuple, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """Encode and decode in one pass: (doc_id, n_ids, ids_crc32, lossless).

    The checksum is over the ids as little-endian unsigned 32-bit integers.  A null text counts as
    empty.
    """

    def some(codec: Codec, doc_ids: list, texts: list) -> list[pa.Array]:
        texts = [t or "" for t in texts]
        ids, ends = codec.encode_all(texts, [_key(seed, i, t) for i, t in zip(doc_ids, texts, strict=True)])
        each = [one.tobytes() for one in np.split(ids, ends[:-1])]
        return [
            pa.array([len(one) // 4 for one in each], pa.int64()),
            pa.array([zlib.crc32(one) for one in each], pa.int64()),
            pa.array([codec.decode(one) == text for one, text in zip(each, texts, strict=True)], pa.bool_()),
        ]

    columns = "n_ids long, ids_crc32 long, lossless boolean"
    return _mapped(docs.select(F.col("doc_id").cast("long"), "text"), (parts, dropout), some, columns)


def public_model() -> tuple:
    import public_tokenizers

    return model_parts(public_tokenizers.path("piece_bpe_32k.model"))


@query("op9_sentencepiece_dropout")
def op9_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with merge-dropout and decoded again."""
    return round_trip(table(spark, sf_dir, "documents"), public_model())

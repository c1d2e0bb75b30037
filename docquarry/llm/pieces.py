"""SentencePiece encoding and decoding with N-best segmentations.

A text is normalised as its model says (by the library's normaliser, unless the
model leaves texts as they are): a dummy prefix, and spaces as ``▁``.  Its segmentations
are the paths of a lattice of pieces; a character in no piece is spelled by byte
pieces or, if the model has none, unknown (unknown neighbours are one piece, which
decodes as the model's mark for it).  Forward Viterbi gives every
position's best score from the start.  Those scores are exact heuristics for an
A* search backward from the end, so whole paths leave the queue in the order of
their scores, and the first N are the N best.

No piece goes over a word's start (``▁`` is only ever first in a piece, or in a
run of its own), so the lattice of a text is a chain of its words' lattices,
and often of their parts'.  Each distinct part's best path and the difference to its second best come from
one forward and one backward pass, and are remembered up to a bound.  Only words
with the N - 1 smallest differences can change in any of the text's N best, so
only those are searched, and the text's N best are merged from theirs.

Scores are whole numbers (millionths of a logarithm), so ties are ties; they
come in the order in which the search, which is deterministic, completes them.  A unigram
model's own scores are used, and its best path is what the library encodes to.
A BPE model has ranks for scores, which are no logarithms of probabilities;
Zipf's law makes them ones for the lattice.  The library's own segmentation goes
by merges, so it is often another path: ``piece_ids`` are always the library's,
and ``lattice_ids`` the lattice's best.

Models whose pieces go over a word's start, that have no dummy prefix or no piece
for a space are refused.

Defined results: null text is empty and has the one empty segmentation; a text's
own ``▁`` decodes as a space, as in the library; repeated rows get equal results; an
empty table gives an empty table; other columns are ignored, or kept by
``with_pieces``, which puts underscores after its own names where they clash.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from .common import bound_batches, by_bytes
from .token_counts import tokenizer_path

#: How a model writes a space, and how it stands here: as itself, so that most words take a byte a character.
MARK, SPACE = "▁", " "
#: Segmentations of each text; words that a worker remembers, and the longest that it does.
BEST, KNOWN, LONGEST = 3, 400_000, 64
#: Bytes of text that are encoded together, about: ids take ten times as much on their way.  A quarter, where whole rows are kept beside them.
BATCH_BYTES = 4 << 20
#: Words in one array of ``viterbi_many``.
CHUNK = 4096
#: The kinds of pieces in a model, normal, unknown and user-defined ones, and bytes; what an unknown character costs beyond the worst piece.
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
UNKNOWN_COST = 10
ZIPF_SHIFT = 2.7
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Stands for "no second segmentation" among differences.
NONE = 1 << 62


class Pieces:
    """The pieces of a model with whole-number scores."""

    def __init__(self, name: str):
        from sentencepiece import sentencepiece_model_pb2 as format

        model = format.ModelProto()
        with open(tokenizer_path(name), "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if not spec.add_dummy_prefix or not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with a dummy prefix are known here")
        self.library = SentencePieceProcessor(model_proto=model.SerializeToString())
        self.identity = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces
        ranks = self.merges = model.trainer_spec.model_type == 2
        size = len(model.pieces)
        weight = sum(1 / (k + ZIPF_SHIFT) for k in range(size))
        self.ids: dict[str, tuple[int, int]] = {}
        self.bytes: list[tuple[int, int]] = [(0, 0)] * 256
        self.spelled = [b""] * size
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == UNKNOWN), 0)
        self.falls_back = any(p.type == BYTE for p in model.pieces)
        for i, p in enumerate(model.pieces):
            if p.type == UNKNOWN:
                self.spelled[i] = model.trainer_spec.unk_surface.encode()
            elif p.type in (NORMAL, USER):
                rank = min(max(-p.score, 0), size) if ranks else 0
                score = -log((rank + ZIPF_SHIFT) * weight) if ranks else p.score
                self.ids[p.piece.replace(MARK, SPACE)] = i, round(score * 1_000_000)
                self.spelled[i] = p.piece.replace(MARK, SPACE).encode()
        lowest = min((s for _, s in self.ids.values()), default=0) - 2_000_000
        worst = min((p.score for p in model.pieces if p.type == NORMAL), default=0.0)
        self.unknown_score = None if ranks and self.falls_back else round((worst - UNKNOWN_COST) * 1_000_000)
        if SPACE not in self.ids:
            raise ValueError("no piece for a space")
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes[value] = i, lowest
                self.spelled[i] = bytes([value])
        self.longest = max(map(len, self.ids), default=1)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or any(p.startswith(SPACE * 2) and p.strip(SPACE) for p in self.ids):
            raise ValueError("pieces go over a word's start")
        # More places that no piece goes over: before a mark that follows no letter or digit in
        # any piece, and around line ends if they are in no longer piece.
        pairs = {x for p in self.ids for x in zip(p, p[1:])}
        joined = {b for a, b in pairs if a.isalnum()}
        marks = "".join(sorted(re.escape(p) for p in self.ids if len(p) == 1 and not p.isalnum() and p not in joined and p not in (SPACE, "\n")))
        lines = "" if any("\n" in x for x in pairs) or not (self.falls_back or "\n" in self.ids) else "\n"
        rest = rf"(?:[^{lines}{marks}]++" + (rf"|(?<![^\W_])[{marks}])*+" if marks else ")*+")
        self.part_pattern = re.compile("|".join([*([r"\n"] if lines else []), *([rf"[{marks}]{rest}"] if marks else []), rf"[\s\S]{rest}"]))
        self.breaks = frozenset(p for p in self.ids if re.fullmatch(f"[{marks}]", p)) | set(lines) if marks else frozenset(lines)
        #: Pieces by their characters; 0 for what only starts a piece.
        self.starts: dict[str, tuple[int, int] | int] = {p[:k]: 0 for p in self.ids for k in range(1, len(p))} | self.ids
        self.singles = frozenset(p for p in self.ids if len(p) == 1)
        self._trie()

    def _spelled(self, char: str) -> tuple[tuple[int, ...], int]:
        """Byte pieces of a character that is no piece, or the unknown one, and their score."""
        found = [self.bytes[b] for b in char.encode("utf-8", "replace")] if self.falls_back else [(self.unknown, 0)]
        return tuple(i for i, _ in found), sum(s for _, s in found) if self.unknown_score is None else self.unknown_score

    def joined(self, ids: Iterable[int]) -> tuple[int, ...]:
        """The ids with unknown neighbours as one."""
        ids = tuple(ids)
        if self.falls_back or self.unknown not in ids:
            return ids
        return tuple(i for k, i in enumerate(ids) if i != self.unknown or not k or ids[k - 1] != i)

    def edges(self, word: str) -> list[tuple[int, int, int]]:
        """The lattice's edges (start, end, score), by start."""
        get, longest, size = self.starts.get, self.longest, len(word)
        out = []
        for start in range(size):
            for end in range(start + 1, min(start + longest, size) + 1):
                found = get(word[start:end])
                if found:
                    out.append((start, end, found[1]))
                    continue
                if end == start + 1:
                    out.append((start, end, self._spelled(word[start])[1]))
                if found is None:  # nor does any piece start so
                    break
        return out

    def ids_of(self, part: str) -> tuple[int, ...]:
        """The ids of an edge's characters."""
        found = self.ids.get(part)
        return found[:1] if found else self._spelled(part)[0]

    def viterbi(self, word: str) -> tuple[int, tuple[int, ...], int]:
        """Score and piece ids of the best segmentation, and how much worse the second best is.

        Any other segmentation has an edge off the best path, so the second best is
        the best one through such an edge: forward score, edge, backward score.
        """
        size, edges = len(word), self.edges(word)
        best, back = [0] + [-NONE] * size, [0] * (size + 1)
        for start, end, score in edges:
            score += best[start]
            if score > best[end]:
                best[end] = score
                back[end] = start
        on_path, at, parts = [-1] * (size + 1), size, []
        while at:
            on_path[at] = back[at]
            parts.append(word[back[at] : at])
            at = back[at]
        after, second = [-NONE] * size + [0], -NONE
        for start, end, score in reversed(edges):
            score += after[end]
            if score > after[start]:
                after[start] = score
            score += best[start]
            if score > second and on_path[end] != start:
                second = score
        ids = self.joined(i for part in reversed(parts) for i in self.ids_of(part))
        return best[size], ids, best[size] - second if second > -(NONE >> 1) else NONE

    def viterbi_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``viterbi`` of many words at once: scores, differences, numbers of ids, and all ids in a row.

        The words' characters are all pieces.

        One array step handles the edges of all words with the same start and
        length, and the walk along a word's characters is one along a trie.
        """
        size = len(words)
        lengths = np.array([len(w) for w in words])
        longest = int(lengths.max())
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        chars = np.full((size, longest), -1, np.int64)
        chars[np.arange(longest) < lengths[:, None]] = self.char_ids[points]
        best = np.full((size, longest + 1), -NONE, np.int64)
        best[:, 0] = 0
        back, piece_at = np.zeros((size, longest + 1), np.int32), np.zeros((size, longest + 1), np.int32)
        edges = []
        for start in range(longest):
            rows, nodes = np.flatnonzero(lengths > start), None
            for end in range(start + 1, min(start + self.longest, longest) + 1):
                nodes, alive = self._walk(nodes, chars[rows, end - 1])
                rows, nodes = rows[alive], nodes[alive]
                if not len(rows):
                    break
                pieces = self.node_piece[nodes]
                hit = pieces >= 0
                at, found = rows[hit], pieces[hit]
                if not len(at):
                    continue
                scores = self.piece_score[found]
                edges.append((start, end, at, scores))
                total = best[at, start] + scores
                better = total > best[at, end]
                at, found = at[better], found[better]
                best[at, end], back[at, end], piece_at[at, end] = total[better], start, found
        every = np.arange(size)
        on_path = np.full((size, longest + 1), -1, np.int32)
        ids, begin, now = np.zeros((size, longest), np.int32), np.full(size, longest), lengths.copy()
        left = every
        while len(left):
            where = now[left]
            on_path[left, where] = back[left, where]
            begin[left] -= 1
            ids[left, begin[left]] = piece_at[left, where]
            now[left] = back[left, where]
            left = left[now[left] > 0]
        after = np.full((size, longest + 1), -NONE, np.int64)
        after[every, lengths] = 0
        second = np.full(size, -NONE, np.int64)
        for start, end, at, scores in reversed(edges):
            total = after[at, end] + scores
            after[at, start] = np.maximum(after[at, start], total)
            total = np.where(on_path[at, end] == start, -NONE, best[at, start] + total)
            second[at] = np.maximum(second[at], total)
        score = best[every, lengths]
        gap = np.where(second > -(NONE >> 1), score - second, NONE)
        return score, gap, longest - begin, ids[np.arange(longest) >= begin[:, None]]

    def _walk(self, nodes: np.ndarray | None, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The trie's nodes after one more character each (None: from the root), and which of them there are."""
        if nodes is None:
            found = self.root_steps[chars]
            return found, found > 0
        there = (nodes < len(self.steps)) & (chars >= 0) & (chars < self.steps.shape[1])
        found = self.steps[nodes * there, chars * there]
        return found, there & (found > 0)

    def _trie(self) -> None:
        """Arrays of the trie of pieces for ``viterbi_many``.

        Nodes with children come first, and characters within longer pieces, so
        the table of steps below the root is small.
        """
        inner = {p[:-1] for p in self.starts}
        later = sorted({c for p in self.ids for c in p[1:]})
        alphabet = {c: i for i, c in enumerate([*later, *sorted({p[0] for p in self.ids}.difference(later))])}
        self.char_ids = np.full(0x110000, -1, np.int32)
        self.char_ids[[ord(c) for c in alphabet]] = np.arange(len(alphabet))
        names = ["", *sorted(inner - {""}), *sorted(p for p in self.starts if p not in inner)]
        nodes = {p: i for i, p in enumerate(names)}
        number = np.uint16 if len(names) < 1 << 16 else np.int32
        self.steps = np.zeros((len(inner | {""}), len(later)), number)
        self.root_steps = np.zeros(len(alphabet), number)
        for p, n in nodes.items():
            if len(p) == 1:
                self.root_steps[alphabet[p]] = n
            elif p:
                self.steps[nodes[p[:-1]], alphabet[p[-1]]] = n
        found = [self.starts.get(p) for p in names]
        self.node_piece = np.array([f[0] if f else -1 for f in found], np.int32)
        self.piece_score = np.zeros(len(self.spelled), np.int64)
        for i, score in self.ids.values():
            self.piece_score[i] = score

    def spells(self, word: str) -> bool:
        """Whether each of its characters is a piece."""
        return self.singles.issuperset(word)

    def nbest(self, word: str, n: int) -> list[tuple[int, tuple[int, ...]]]:
        """The ``n`` best segmentations as (score, piece ids), best first."""
        into: list[list[tuple[int, int]]] = [[] for _ in range(len(word) + 1)]
        best = [0] + [-NONE] * len(word)
        for start, end, score in self.edges(word):
            into[end].append((start, score))
            best[end] = max(best[end], best[start] + score)
        # Backward A*: a state is a position and the path behind it; its estimate is exact.
        # Of equal estimates the state nearest the start goes first, so ties are no search in breadth.
        queue: list[tuple[int, int, int, int, tuple]] = [(-best[-1], len(word), 0, 0, ())]
        out, serial = [], 0
        while queue and len(out) < n:
            _, at, _, done, path = heapq.heappop(queue)
            if at == 0:
                ids: list[int] = []
                start = 0
                while path:
                    end, path = path
                    ids += self.ids_of(word[start:end])
                    start = end
                out.append((done, self.joined(ids)))
                continue
            for start, score in into[at]:
                serial += 1
                heapq.heappush(queue, (-(best[start] + done + score), start, serial, done + score, (at, path)))
        return out

    def words(self, text: str) -> list[str]:
        """The words of a text's lattice, in order, each without its first space."""
        text = self.normal(text)
        if not text:
            return []
        words = text.split(SPACE)
        if "" in words:  # runs of spaces belong to the word that follows
            return [w[1:] for w in _WORDS.findall(SPACE + text)]
        return words

    def normal(self, text: str) -> str:
        """A text as the model sees it, with spaces for marks and without the dummy prefix."""
        if not self.identity:
            text = self.library.normalize(text)
            return text[1:].replace(MARK, SPACE)
        return text.replace(MARK, SPACE)

    def parts(self, word: str) -> list[str]:
        """Parts of a word that no piece goes over."""
        return [word] if self.breaks.isdisjoint(word) else self.part_pattern.findall(word)

    def decode(self, ids: list[int]) -> str:
        """The text of piece ids, without the dummy prefix."""
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def load(name: str) -> Pieces:
    return Pieces(name)


class Encoder:
    """N-best segmentations of batches of texts, with a bounded memory of words and of their parts.

    A full memory is forgotten between batches.  Words and parts are numbers into arrays: score, difference to the second
    best, and where their ids lie in one long row.
    """

    def __init__(self, name: str, n: int = BEST):
        self.pieces, self.n = load(name), n
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.known_parts: dict[str, int] = {}
        self.known_ways: dict[str, list[tuple[int, int]]] = {}
        self.long: list[tuple[dict[str, int], str]] = []
        self.size = self.used = 0
        self.score, self.gap, self.first, self.count = (np.zeros(1 << 16, np.int64) for _ in range(4))
        self.row = np.zeros(1 << 18, np.int32)
        self.own = Row()

    def _add(self, score: np.ndarray, gap: np.ndarray, count: np.ndarray, ids: np.ndarray) -> range:
        """Put entries at the arrays' ends; their numbers."""
        new = range(self.size, self.size + len(score))
        while new.stop > len(self.score):
            self.score, self.gap, self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.score, self.gap, self.first, self.count))
        while self.used + len(ids) > len(self.row):
            self.row = np.concatenate([self.row, np.zeros_like(self.row)])
        at = slice(new.start, new.stop)
        self.score[at], self.gap[at], self.count[at] = score, gap, count
        self.first[at] = self.used + np.cumsum(count) - count
        self.row[self.used : self.used + len(ids)] = ids
        self.size, self.used = new.stop, self.used + len(ids)
        return new

    def _ids(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of entries, in a row."""
        count = self.count[numbers]
        shift = self.first[numbers] - (np.cumsum(count) - count)
        return self.row[np.repeat(shift, count) + np.arange(int(count.sum()))]

    def _best(self, parts: list[str], keys: list[str], into: dict[str, int]) -> None:
        """Best paths of parts, put into memory under their keys."""
        many = [(p, k) for p, k in zip(parts, keys) if len(p) <= LONGEST and self.pieces.spells(p)]
        many.sort(key=lambda x: len(x[0]))  # by length: little is padding
        for start in range(0, len(many), CHUNK):
            chunk = many[start : start + CHUNK]
            into.update(zip([k for _, k in chunk], self._add(*self.pieces.viterbi_many([p for p, _ in chunk]))))
        for p, k in zip(parts, keys) if len(many) < len(parts) else ():
            if len(p) > LONGEST:
                self.long.append((into, k))
            if k not in into:
                score, ids, gap = self.pieces.viterbi(p)
                into.update(zip([k], self._add(*(np.array([x]) for x in (score, gap, len(ids))), np.array(ids, np.int32))))

    def learn(self, words: set[str]) -> None:
        """Put new words into memory.

        A part with a word's start is remembered as that word; only parts from
        within words have a memory of their own.
        """
        whole = self.pieces.breaks.isdisjoint
        mixed = [w for w in words if not whole(w)]
        split = [self.pieces.parts(SPACE + w) for w in mixed]
        composed = [(w, own) for w, own in zip(mixed, split) if len(own) > 1]
        own_parts = set().union(*(own for _, own in composed))
        base = words.difference(w for w, _ in composed) | {p[1:] for p in own_parts if p[0] == SPACE}.difference(self.known)
        inner = [p for p in own_parts if p[0] != SPACE and p not in self.known_parts]
        base = list(base)
        self._best([SPACE + w for w in base], base, self.known)
        self._best(inner, inner, self.known_parts)
        if composed:
            lengths = np.array([len(own) for _, own in composed])
            starts = np.cumsum(lengths) - lengths
            numbers = np.fromiter((self.known[p[1:]] if p[0] == SPACE else self.known_parts[p] for _, own in composed for p in own), np.int64, int(lengths.sum()))
            sums = [np.add.reduceat(x[numbers], starts) for x in (self.score, self.count)]
            added = self._add(sums[0], np.minimum.reduceat(self.gap[numbers], starts), sums[1], self._ids(numbers))
            self.known.update(zip([w for w, _ in composed], added))
        if self.pieces.merges:  # no merge goes over a word's start, so words may be encoded one by one
            new = [*base, *(w for w, _ in composed)]
            found = self.pieces.library.encode(new, num_threads=1) if new else []
            alone = [self.pieces.ids[SPACE][0]]  # a space at the text's end, which by itself is an empty text
            self.own.put([self.known[w] for w in new], [ids if w else alone for w, ids in zip(new, found)])
        if composed:
            self.long += [(self.known, w) for w, _ in composed if len(w) > LONGEST]

    def ways(self, word: str, number: int) -> list[tuple[int, int, tuple[int, ...]]]:
        """(score lost, pieces added, ids) of the word's N best, the best first."""
        out = self.known_ways.get(word)
        if out is None:
            best, score = tuple(self._ids(np.array([number])).tolist()), int(self.score[number])
            found = [w for w in self.pieces.nbest(SPACE + word, self.n) if w[1] != best]
            out = [(0, 0, best), *((score - s, len(ids) - len(best), ids) for s, ids in found[: self.n - 1])]
            if len(word) <= LONGEST:
                self.known_ways[word] = out
        return out

    def __call__(self, texts: list[str | None], whole: bool = False) -> Encoded:
        """Segmentations of texts; the ids of all N best only if ``whole``."""
        if max(len(self.known), len(self.known_parts), self.used >> 4) > KNOWN:
            self.forget()
        split = [self.pieces.words(t or "") for t in texts]
        ends = np.cumsum([0, *map(len, split)])
        flat = list(chain.from_iterable(split))
        numbers = np.fromiter(map(self.known.get, flat, repeat(-1)), np.int64, len(flat))
        new = np.flatnonzero(numbers < 0)
        words = [flat[k] for k in new.tolist()]
        self.learn(set(words))
        numbers[new] = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        sums = [np.concatenate([[0], np.cumsum(x[numbers])])[ends] for x in (self.score, self.count)]
        gaps = self.gap[numbers]
        out = Encoded(self._ids(numbers), sums[1].astype(np.int32), [], [], [])
        for k, (score, count) in enumerate(zip(np.diff(sums[0]).tolist(), np.diff(sums[1]).tolist())):
            left, picked = gaps[ends[k] : ends[k + 1]], []
            for _ in range(min(self.n - 1, len(left))):  # the nearest second bests
                at = int(left.argmin())
                if left[at] == NONE:
                    break
                left[at] = NONE
                picked.append((at, self.ways(split[k][at], int(numbers[ends[k] + at]))))
            every: list[tuple[int, int, tuple[int, ...]]] = [(0, 0, ())]
            for _, ways in picked:  # the N best of words so far, with each way of the next word
                every = heapq.nsmallest(self.n, [(g + lost, c + more, (*turn, j)) for g, c, turn in every for j, (lost, more, _) in enumerate(ways)], key=lambda w: w[0])
            out.scores.append([score - g for g, _, _ in every])
            out.counts.append([count + c for _, c, _ in every])
            if whole:
                out.ways.append([self._replaced(numbers[ends[k] : ends[k + 1]], {at: ways[j][2] for (at, ways), j in zip(picked, turn) if j}) for _, _, turn in every])
        if self.pieces.merges:
            out.own, count = self.own.take(numbers)
            out.own_offsets = np.concatenate([[0], np.cumsum(count)])[ends].astype(np.int32)
        for memory, key in self.long:  # long ones were for this batch alone
            memory.pop(key, None)
        self.long.clear()
        return out

    def _replaced(self, numbers: np.ndarray, others: dict[int, tuple[int, ...]]) -> list[int]:
        """The ids of words, some of them in another way."""
        out, at = [], 0
        for k in sorted(others):
            out += [*self._ids(numbers[at:k]).tolist(), *others[k]]
            at = k + 1
        return [*out, *self._ids(numbers[at:]).tolist()]


class Row:
    """Lists of ids in one long row, by entry numbers."""

    def __init__(self) -> None:
        self.first, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids, self.used = np.zeros(1 << 18, np.int32), 0

    def put(self, numbers: list[int], lists: list[list[int]]) -> None:
        if not numbers:
            return
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        while max(numbers) >= len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count))
        while self.used + int(count.sum()) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.first[numbers], self.count[numbers] = self.used + np.cumsum(count) - count, count
        self.ids[self.used : self.used + int(count.sum())] = np.fromiter(chain.from_iterable(lists), np.int32, int(count.sum()))
        self.used += int(count.sum())

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of entries in a row, and how many each has."""
        count = self.count[numbers]
        shift = self.first[numbers] - (np.cumsum(count) - count)
        return self.ids[np.repeat(shift, count) + np.arange(int(count.sum()))], count


@dataclass
class Encoded:
    """Segmentations of a batch: the best ones' ids in a row and where each text's begin and end, and of each text's N best scores and piece counts, and all ids if asked for; the library's ids."""

    row: np.ndarray
    offsets: np.ndarray
    scores: list[list[int]]
    counts: list[list[int]]
    ways: list[list[list[int]]]
    own: np.ndarray | None = None
    own_offsets: np.ndarray | None = None

    def lattice_ids(self) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(self.offsets), pa.array(self.row))

    def piece_ids(self) -> pa.ListArray:
        """The library's ids; for a unigram model they are the lattice's best."""
        return self.lattice_ids() if self.own is None else pa.ListArray.from_arrays(pa.array(self.own_offsets), pa.array(self.own))

    @staticmethod
    def each(lists: pa.ListArray) -> list[np.ndarray]:
        """The lists' values, one array each."""
        values, ends = lists.values.to_numpy(), lists.offsets.to_pylist()
        return [values[a:b] for a, b in zip(ends, ends[1:])]


def encode(df: DataFrame, model: str = "piece_bpe_32k.model", *, id_column: str = "doc_id", text_column: str = "text", n: int = BEST, whole: bool = True) -> DataFrame:
    """``id, piece_ids, lattice_ids, scores, counts, nbest_ids, normal_sha256``: the library's segmentation of each text, the
    lattice's best, and the scores, sizes and (null unless ``whole``) ids of the N best."""
    bound_batches(df.sparkSession)
    narrow = df.select(df[id_column].alias("id"), df[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, n)
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            texts = batch.column(1).to_pylist()
            got = encoder(texts, whole)
            normal = [hashlib.sha256(encoder.pieces.normal(x or "").encode("utf-8", "replace")).hexdigest() for x in texts]
            ways = pa.array(got.ways if whole else [None] * len(texts), pa.list_(pa.list_(pa.int32())))
            columns = [got.piece_ids(), got.lattice_ids(), pa.array(got.scores, pa.list_(pa.int64())), pa.array(got.counts, pa.list_(pa.int32())), ways, pa.array(normal)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "piece_ids", "lattice_ids", "scores", "counts", "nbest_ids", "normal_sha256"])

    kind = dict(narrow.dtypes)["id"]
    return narrow.mapInArrow(run, f"id {kind}, piece_ids array<int>, lattice_ids array<int>, scores array<long>, counts array<int>, nbest_ids array<array<int>>, normal_sha256 string").withColumnRenamed("id", id_column)


def decode(df: DataFrame, model: str = "piece_bpe_32k.model", *, id_column: str = "doc_id", ids_column: str = "piece_ids") -> DataFrame:
    """``id, text`` from piece ids; null ids are empty."""
    bound_batches(df.sparkSession)
    narrow = df.select(df[id_column].alias("id"), df[ids_column].alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            texts = [pieces.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return narrow.mapInArrow(run, f"id {dict(narrow.dtypes)['id']}, text string").withColumnRenamed("id", id_column)


def round_trip(df: DataFrame, model: str = "piece_bpe_32k.model", *, id_column: str = "doc_id", text_column: str = "text", n: int = BEST) -> DataFrame:
    """Encode each text, decode the ids, and compare: digests of the library's and the lattice's ids and of the decoded text, and the N best's scores.

    ``round_trip``: both decode to the text as the model sees it.
    """
    bound_batches(df.sparkSession)
    narrow = df.select(df[id_column].alias("id"), df[text_column].alias("text"))
    names = ["id", "n_pieces", "score", "nbest_scores", "nbest_pieces", "ids_sha256", "lattice_sha256", "decoded_sha256", "round_trip"]
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, n)
        pieces = encoder.pieces
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            got = encoder(texts)
            both = [got.each(got.lattice_ids() if lattice else got.piece_ids()) for lattice in (False, True)]
            decoded = [[pieces.decode(x.tolist()) for x in own] for own in both]
            same = [a == b == pieces.normal(t) for a, b, t in zip(*decoded, texts)]
            digests = [[sha(x.astype("<i4", copy=False).tobytes()) for x in own] for own in both] + [[sha(x.encode("utf-8", "replace")) for x in decoded[0]]]
            columns = [pa.array(list(map(len, both[0])), pa.int64()), pa.array([x[0] for x in got.scores], pa.int64()), pa.array(got.scores, pa.list_(pa.int64())), pa.array(got.counts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *(pa.array(x, pa.string()) for x in digests), pa.array(same, pa.bool_())], names)

    out = narrow.mapInArrow(run, f"id {dict(narrow.dtypes)['id']}, n_pieces long, score long, nbest_scores array<long>, nbest_pieces array<int>, ids_sha256 string, lattice_sha256 string, decoded_sha256 string, round_trip boolean")
    return out.withColumnRenamed("id", id_column)


def with_pieces(df: DataFrame, model: str = "piece_bpe_32k.model", *, text_column: str = "text", n: int = BEST) -> DataFrame:
    """``df`` with ``piece_ids`` (the library's), ``lattice_ids``, ``n_pieces`` and ``round_trip`` (of both) added; texts stay beside their pieces."""
    bound_batches(df.sparkSession)
    position = df.columns.index(text_column)
    there = {c.lower() for c in df.columns}
    added = []
    for name in ("piece_ids", "lattice_ids", "n_pieces", "round_trip"):
        while name in there:
            name += "_"
        added.append(name)
    names = [*df.columns, *added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model, n)
        decoded = encoder.pieces.decode
        for batch in by_bytes(batches, text_column, BATCH_BYTES // 4):
            texts = batch.column(position).to_pylist()
            got = encoder(texts)
            ids, lattice = got.piece_ids(), got.lattice_ids()
            same = [all(decoded(x.tolist()) == encoder.pieces.normal(t or "") for x in both) for *both, t in zip(got.each(ids), got.each(lattice), texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, lattice, ids.value_lengths().cast(pa.int64()), pa.array(same, pa.bool_())], names)

    fields = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.mapInArrow(run, f"{fields}, `{added[0]}` array<int>, `{added[1]}` array<int>, `{added[2]}` long, `{added[3]}` boolean")

"""Distinct random segmentations: Gumbel top-k without replacement on the lattice.

A text's segmentations into vocabulary pieces are the paths of a lattice, each
with a probability in proportion to the product of its pieces' probabilities.
Adding independent Gumbel noise to the log probabilities and taking the k
largest draws k distinct paths without replacement. The search never lists
paths: it is best-first over regions of paths. The backward sums of the lattice
give a region's total mass, so its largest perturbed value can be drawn
directly, given that its parent's is larger. Taking the best region fixes one
path in it by forward sampling; what is left of the region splits, at every
piece of that path, into the paths that share what comes before and differ
there.

An inclusion score is the chance that a path is among the k, given the
(k+1)-th value: 1 - exp(-exp(log p - threshold)).

Texts split before each run of spaces, which no piece crosses, so the lattice is
a chain of those of its words; a word's lattice is built once per worker. All
texts of a batch are searched together, one step for all. Noise is a hash of
the row's key, the round, the word and the step, so it depends on the row alone.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from alertscope.llm.common import prepare
from alertscope.llm.double_array import DoubleArray, double_array

SPACE = "▁"  # stands for a space in pieces
#: Log probability below the least piece's that a character without a piece gets.
UNKNOWN_PENALTY = 10.0
#: Characters of text that are searched together, and lattice edges kept.
BATCH_CHARS = 300_000
KEPT_EDGES = 4_000_000
#: Longer words get their lattice one by one.
LONGEST_TOGETHER = 64
#: Sums below this are scaled up again, before they underflow.
TINY = 1e-250

_U = np.uint64


class Lattices:
    """Word lattices of one vocabulary as flat arrays.

    Node g has the edges ``first[g]`` up to ``first[g + 1]``, of falling probability;
    ``cdf`` is their cumulative probability.
    """

    def __init__(self, model: bytes, smoothing: float) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        score = {i: sp.get_score(i) for i in plain}
        if all(s == int(s) for s in score.values()):
            # a merge list has ranks for scores: by Zipf's law the r-th piece has a
            # probability in proportion to 1 / r
            norm = math.log(math.fsum(1 / (1 - s) for s in score.values()))
            score = {i: -math.log(1 - s) - norm for i, s in score.items()}
        self.pieces = {sp.id_to_piece(i): ((i,), math.exp(s * smoothing)) for i, s in score.items()}
        self.heads = {p[:n] for p in self.pieces for n in range(1, len(p))}
        self.longest = max(map(len, self.pieces))
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece crosses the start of a word")
        # a line end that no piece joins to anything is a word of its own
        alone = "" if any("\n" in p and len(p) > 1 for p in self.pieces) else "\n"
        self._words = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + ("|\n" if alone else ""))
        self.unknown = math.exp((min(score.values()) - UNKNOWN_PENALTY) * smoothing)
        self.bytes = {sp.id_to_piece(i): i for i in range(n) if sp.is_byte(i)}
        self.unk_id = sp.unk_id()
        self._index()
        self.clear()

    def _index(self) -> None:
        """The pieces as a double array: all places of all new words advance together."""
        chars = sorted({c for p in self.pieces for c in p} - {"\0"})
        self.code = np.zeros(0x110000, dtype=np.int32)  # 0: no piece has the character
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.alone = {c for c in chars if c in self.pieces}
        states = {"": 0}
        for part in (p[:n] for p in self.pieces if "\0" not in p for n in range(1, len(p) + 1)):
            states.setdefault(part, len(states))
        some = [s for s in states if s]
        parents, codes, children = (
            np.array(c, dtype=np.int32)
            for c in ([states[s[:-1]] for s in some], self.code[[ord(s[-1]) for s in some]], [states[s] for s in some])
        )
        self.array: DoubleArray = double_array(parents, codes, children, len(states), len(chars) + 1)
        self.piece_prob = np.full(len(states), -1.0)  # below 0: a state that is no piece
        self.piece_id = np.zeros(len(states), dtype=np.uint32)
        for part, (ids, prob) in self.pieces.items():
            if part in states:
                self.piece_prob[states[part]], self.piece_id[states[part]] = prob, ids[0]

    def clear(self) -> None:
        self.start: dict[str, int] = {}
        self.n_nodes = self.n_edges = 0
        self._new: list[list] = [[] for _ in range(5)] + [[0]]
        self._kept = [np.zeros(1 << 16, dtype=t) for t in (float, np.int32, float, np.uint8, np.uint32, np.int64)]
        self._used = [0] * 6

    def words(self, text: str | None) -> list[str]:
        """The words of a text with their spaces; a space goes before the first."""
        return self._words.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def fallback(self, char: str) -> list[int]:
        """Ids of a character that no piece covers: its bytes, else the unknown id."""
        if not self.bytes:
            return [self.unk_id]
        return [self.bytes[f"<0x{b:02X}>"] for b in char.encode("utf-8", "surrogatepass")]

    def add(self, word: str) -> None:
        """Backward sums in plain numbers, scaled up again before they underflow; only
        ratios within the reach of one piece matter."""
        n, base = len(word), self.n_nodes
        pieces, heads, reach = self.pieces, self.heads, self.longest
        mass = [0.0] * n + [1.0]
        cdf, to, prob, sizes, ids, first = self._new
        nodes = []
        for i in range(n - 1, -1, -1):
            own, total = [], 0.0
            for j in range(i + 1, min(n, i + reach) + 1):
                part = word[i:j]
                hit = pieces.get(part)
                if hit is not None:
                    x = hit[1] * mass[j]
                    total += x
                    own.append((x, j, hit[0]))
                elif j == i + 1:
                    x = self.unknown * mass[j]
                    total += x
                    own.append((x, j, tuple(self.fallback(part))))
                if part not in heads:
                    break
            nodes.append((total, own))
            if total < TINY:
                for j in range(i + 1, min(n, i + reach) + 1):
                    mass[j] *= 1e250
                total *= 1e250
            mass[i] = total
        for i, (total, own) in enumerate(reversed(nodes)):
            # the likelier edges first, so that a drawn one is found soon
            own.sort(reverse=True)
            sure = 0.0
            for x, j, piece in own:
                p = x / total
                sure += p
                cdf.append(sure)
                to.append(base + j if j < n else -1)
                prob.append(p)
                sizes.append(len(piece))
                ids.extend(piece)
            cdf[-1] = 2.0  # the last edge takes every number that is left
            first.append(self.n_edges + len(cdf))
        self.start[word] = base
        self.n_nodes += n

    def learn(self, words: list[str]) -> None:
        """Lattices of new words, all places of all words together; what ``add`` gives to
        the last bit. Words with a character that no piece is, very long ones and those
        whose sums are tiny are added one by one."""
        self.settle()
        alone = self.alone
        together = [w for w in words if len(w) <= LONGEST_TOGETHER and alone.issuperset(w)]
        for word in self._add_together(together) if together else []:
            self.add(word)
        for word in words:
            if word not in self.start:
                self.add(word)

    def _add_together(self, words: list[str]) -> list[str]:
        """Adds all words but those it returns."""
        # a place for each character, and one for each word's end
        codes = self.code[np.frombuffer("\0".join([*words, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        end = np.cumsum(sizes + 1) - 1
        word_of = np.repeat(np.arange(len(words)), sizes + 1)
        inside = np.ones(len(codes), dtype=bool)
        inside[end] = False
        at = np.flatnonzero(inside)
        ahead = (end[word_of] - np.arange(len(codes))).astype(np.int16)
        # places by their distance from the word's end; edges of a place the shorter
        # first, so that the sums are those of one word alone
        nodes = at[np.argsort(ahead[at], kind="stable")]
        state, found, seen = np.zeros(len(at), dtype=np.int32), [], np.zeros(len(codes), dtype=np.int64)
        for level in range(1, self.longest + 1):
            hit, after = self.array.advance(state, codes[at + level - 1])
            at, state = at[hit], after[hit]
            if not len(at):
                break
            some = self.piece_prob[state] >= 0
            place = at[some]
            found.append((place, place + level, state[some], seen[place]))
            seen[place] += 1
        counts = seen[nodes]
        first = np.cumsum(counts) - counts
        seen[nodes] = first
        total = int(counts.sum())
        src, to, piece = np.empty(total, dtype=np.int64), np.empty(total, dtype=np.int64), np.empty(total, dtype=np.int32)
        for place, after, state, turn in found:
            slot = seen[place] + turn
            src[slot], to[slot], piece[slot] = place, after, state
        prob = self.piece_prob[piece]
        node_of = np.repeat(np.arange(len(nodes)), counts)
        levels = np.searchsorted(ahead[nodes], np.arange(1, int(sizes.max()) + 2))
        mass, x = np.ones(len(codes)), np.empty(len(src))
        edges = np.append(first, len(src))[levels]
        for a, b, lo, hi in zip(levels[:-1], levels[1:], edges[:-1], edges[1:]):
            x[lo:hi] = prob[lo:hi] * mass[to[lo:hi]]
            mass[nodes[a:b]] = np.bincount(node_of[lo:hi] - a, weights=x[lo:hi], minlength=b - a)
        tiny = np.zeros(len(words), dtype=bool)
        tiny[word_of[nodes[mass[nodes] < TINY]]] = True
        good = ~tiny[word_of]
        # the likelier edges of a place first, the longer of equals, in the places' order:
        # an edge's rank is the number of those of its place that go before it
        turn = np.arange(total, dtype=np.int32) - np.repeat(first, counts).astype(np.int32)
        more, rank = np.repeat(counts, counts) - turn, np.zeros(total, dtype=np.int32)
        on, step = np.arange(total), 1
        while len(on := on[more[on] > step]):
            later = x[on] <= x[on + step]
            rank[on[later]] += 1
            rank[on[~later] + step] += 1
            step += 1
        begin = np.zeros(len(codes), dtype=np.int64)
        begin[nodes] = np.where(good[nodes], counts, 0)
        begin = np.cumsum(begin) - begin
        own = np.flatnonzero(good[src])
        keep = np.empty(len(own), dtype=np.int64)
        keep[begin[src[own]] + rank[own]] = own
        src, to, piece, x = src[keep], to[keep], piece[keep], x[keep]
        p = x / mass[src]
        first = np.flatnonzero(np.concatenate(([True], src[1:] != src[:-1])) if len(src) else [])
        counts = np.diff(np.append(first, len(src)))
        cdf, sure, turn = np.empty(len(src)), np.zeros(len(first)), 0
        on = np.arange(len(first))
        while len(on):
            sure[on] += p[first[on] + turn]
            cdf[first[on] + turn] = sure[on]
            turn += 1
            on = on[counts[on] > turn]
        cdf[first + counts - 1] = 2.0  # the last edge takes every number that is left
        number = np.cumsum(inside & good) - 1 + self.n_nodes
        self._append([cdf, np.where(inside[to], number[to], -1), p, np.ones(len(src), dtype=np.uint8),
                      self.piece_id[piece], self.n_edges + first + counts])
        begin = number[end - sizes]
        self.start.update((w, b) for w, b, t in zip(words, begin.tolist(), tiny.tolist()) if not t)
        self.n_nodes += len(first)
        self.n_edges = self._used[0]
        return [w for w, t in zip(words, tiny.tolist()) if t]

    def settle(self) -> Lattices:
        """Append the words added to the flat arrays."""
        self._append(self._new)
        self.n_edges = self._used[0]
        self._new = [[] for _ in range(6)]
        self.cdf, self.to, self.prob, self.sizes, self.ids, self.first = (
            a[:n] for a, n in zip(self._kept, self._used)
        )
        self.plain = len(self.ids) == self.n_edges
        self.id_start = None if self.plain else np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        return self

    def _append(self, columns: list) -> None:
        """Onto the flat arrays, which double as they fill."""
        for i, values in enumerate(columns):
            used, n = self._used[i], len(values)
            if used + n > len(self._kept[i]):
                larger = np.zeros(2 * (used + n), dtype=self._kept[i].dtype)
                larger[:used] = self._kept[i][:used]
                self._kept[i] = larger
            self._kept[i][used : used + n] = values
            self._used[i] += n

    def edge(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each node at the cumulative probability u."""
        out = self.first[nodes]
        far = np.flatnonzero(self.cdf[out] <= u)
        while len(far):
            out[far] += 1
            far = far[self.cdf[out[far]] <= u[far]]
        return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _mixed(seed: np.ndarray, turn: int, word: np.ndarray, stream: int) -> np.ndarray:
    """What the numbers of a word have in common."""
    with np.errstate(over="ignore"):
        x = _mix(seed + _U(2 * turn + stream) * _U(0x9E3779B97F4A7C15))
        return _mix(x + word.astype(np.uint64) * _U(0xD1B54A32D192ED03))


def _uniform(mixed: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on the word's and the step alone."""
    with np.errstate(over="ignore"):
        x = _mix(mixed + step.astype(np.uint64) * _U(0x8CB92BA72F3D8DD7))
    return ((x >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)


def _truncated(location: np.ndarray, bound: np.ndarray, uniform: np.ndarray) -> np.ndarray:
    """Gumbel variables at ``location`` given that they are below ``bound``."""
    noise = -np.log(-np.log1p(-uniform) + np.exp(np.minimum(location - bound, 700.0)))
    return np.where(np.isneginf(location), -np.inf, location + noise)


class _Search:
    """The search over a batch of texts; a decision is one piece of one path."""

    def __init__(self, lattices: Lattices, texts: list[list[str]], seeds: np.ndarray, starts: np.ndarray) -> None:
        """``starts``: the first node of each word of all texts, in order."""
        self.l, self.seeds = lattices, seeds
        counts = np.array([len(t) for t in texts], dtype=np.int64)
        self.first_word = np.cumsum(counts) - counts
        self.n_words = counts
        self.doc_of = np.repeat(np.arange(len(texts)), counts)
        self.word_start = starts
        self.paths: list[dict] = []

    def _walk(self, words: np.ndarray, nodes: np.ndarray, steps: np.ndarray, turn: int):
        """Forward sampling from ``nodes`` to the ends of their words."""
        out = []
        doc = self.doc_of[words]
        mixed = _mixed(self.seeds[doc], turn, words - self.first_word[doc], 0)
        while len(words):
            edge = self.l.edge(nodes, _uniform(mixed, steps))
            out.append((words, steps, nodes, edge))
            nodes = self.l.to[edge]
            on = np.flatnonzero(nodes >= 0)
            words, nodes, steps, mixed = words[on], nodes[on], steps[on] + 1, mixed[on]
        return out

    def _finish(self, parts: list, docs: np.ndarray, tops: np.ndarray, turn: int, fixed: dict | None) -> dict:
        """A path per doc of ``docs`` from its decisions, with the regions it leaves."""
        word, step, node, edge = (np.concatenate([p[i] for p in parts]) for i in range(4))
        # a word's steps are 0, 1, ...: each decision has its place
        counts = np.bincount(word, minlength=len(self.doc_of))
        offset = np.cumsum(counts) - counts
        place = offset[word] + step
        there = node, edge
        node, edge = np.empty_like(node), np.empty_like(edge)
        node[place], edge[place] = there
        word = np.repeat(np.arange(len(counts)), counts)
        step = np.arange(len(word)) - offset[word]
        doc = self.doc_of[word]
        starts = np.searchsorted(doc, docs)
        local = np.repeat(np.arange(len(docs)), np.diff(np.append(starts, len(doc))))
        prob = self.l.prob[edge]
        logp = np.log(prob)
        ends = np.append(starts[1:], len(edge))
        total = np.empty(len(edge))
        for a, b in zip(starts.tolist(), ends.tolist()):  # by text, so none touches another's rounding
            np.cumsum(logp[a:b], out=total[a:b])
        ahead = total - logp
        left = np.log(np.maximum(1 - prob, 0), where=prob < 1, out=np.full(len(edge), -np.inf))
        if fixed is not None:
            # at the branch, what was excluded before is gone too; what lies before
            # belongs to regions of earlier paths
            left = np.where(np.arange(len(edge)) < (starts + fixed["at"])[local], -np.inf, left)
            left[starts + fixed["at"]] = fixed["left"]
        own = np.flatnonzero(counts)
        mixed = _mixed(self.seeds[self.doc_of[own]], turn, own - self.first_word[self.doc_of[own]], 1)
        u = _uniform(np.repeat(mixed, counts[own]), step)
        value = _truncated(ahead + left, tops[local], u)
        return {"docs": docs, "starts": starts, "ends": ends, "word": word, "step": step, "node": node, "edge": edge,
                "value": value, "tops": tops, "log_prob": total[ends - 1],
                "at": None if fixed is None else fixed["at"], "excluded": None if fixed is None else fixed["excluded"]}

    def run(self, k: int) -> list[tuple[int, dict, int, float]]:
        """``(text, path, its place in it, threshold)`` of all drawn paths, in order of their draw."""
        docs = np.flatnonzero(self.n_words > 0)
        if not len(docs):
            return []
        with np.errstate(over="ignore"):
            u = ((_mix(self.seeds[docs] + _U(0xA0761D6478BD642F)) >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)
        tops = -np.log(-np.log(u))
        every = np.arange(len(self.word_start))
        parts = self._walk(every, self.word_start, np.zeros(len(every), dtype=np.int64), 0)
        self.paths = [self._finish(parts, docs, tops, 0, None)]
        for turn in range(1, k + 1):
            best = np.full(len(self.n_words), -np.inf)
            where = np.full((len(self.n_words), 2), -1, dtype=np.int64)
            for number, path in enumerate(self.paths):
                top = np.maximum.reduceat(path["value"], path["starts"])
                better = top > best[path["docs"]]
                mine = path["docs"][better]
                best[mine] = top[better]
                where[mine, 0] = number
                where[mine, 1] = np.flatnonzero(better)
            if turn == k:
                self.threshold = best
                break
            branch = np.flatnonzero(best > -np.inf)
            if not len(branch):
                self.threshold = best
                break
            self.paths.append(self._branch(branch, where, best, turn))
        out = []
        for path in self.paths:
            out += [(int(d), path, i, float(self.threshold[d])) for i, d in enumerate(path["docs"])]
        return out

    def _branch(self, docs: np.ndarray, where: np.ndarray, best: np.ndarray, turn: int) -> dict:
        l = self.l
        parts, excluded = [], []
        at, taken = np.zeros(len(docs), dtype=np.int64), np.zeros((4, len(docs)), dtype=np.int64)
        for i, d in enumerate(docs.tolist()):
            path, own = self.paths[where[d, 0]], int(where[d, 1])
            a, b = int(path["starts"][own]), int(path["ends"][own])
            t = a + int(path["value"][a:b].argmax())
            path["value"][t] = -np.inf  # taken
            gone = {int(path["edge"][t])}
            if path["at"] is not None and t - a == path["at"][own]:
                gone |= path["excluded"][own]
            at[i] = t - a
            excluded.append(gone)
            taken[:, i] = path["word"][t], path["step"][t], path["node"][t], path["edge"][t]
            parts.append((path["word"][a:t], path["step"][a:t], path["node"][a:t], path["edge"][a:t]))
        word, step, node, _ = taken
        u = _uniform(_mixed(self.seeds[docs], turn, word - self.first_word[docs], 0), step)
        left, edges = np.zeros(len(docs)), np.zeros(len(docs), dtype=np.int64)
        for i, (lo, hi, gone, x) in enumerate(zip(l.first[node].tolist(), l.first[node + 1].tolist(), excluded, u.tolist())):
            choice = [e for e in range(lo, hi) if e not in gone]
            prob = l.prob[choice]
            weights = prob.cumsum()
            pick = min(int(weights.searchsorted(x * weights[-1], "right")), len(choice) - 1)
            edges[i] = choice[pick]
            rest = float(l.prob[choice[:pick] + choice[pick + 1 :]].sum()) if len(choice) > 1 else 0.0
            left[i] = math.log(rest) if rest > 0 else -math.inf
        head = (word, step, node, edges)
        parts.append(head)
        # go on in the branch's word, and through the words after it
        to = l.to[head[3]]
        inside = to >= 0
        after_n = self.first_word[docs] + self.n_words[docs] - head[0] - 1
        later = np.repeat(head[0] + 1 - np.cumsum(after_n) + after_n, after_n) + np.arange(after_n.sum())
        words = np.concatenate((head[0][inside], later))
        nodes = np.concatenate((to[inside], self.word_start[later]))
        steps = np.concatenate((head[1][inside] + 1, np.zeros(len(later), dtype=np.int64)))
        parts += self._walk(words, nodes, steps, turn)
        return self._finish(parts, docs, best[docs], turn, {"at": at, "left": left, "excluded": excluded})

    def ids(self, path: dict, own: int) -> np.ndarray:
        edge = path["edge"][path["starts"][own] : path["ends"][own]]
        if self.l.plain:
            return self.l.ids[edge]
        sizes = self.l.sizes[edge].astype(np.int64)
        at = np.repeat(self.l.id_start[edge] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return self.l.ids[at]


def draw(lattices: Lattices, texts: list[str | None], keys: list, k: int, seed: int) -> list[tuple]:
    """``(text number, draw, ids, log probability, perturbed value, inclusion score)``."""
    out: list[tuple] = []
    at = 0
    while at < len(texts):
        if lattices.n_edges > KEPT_EDGES:
            lattices.clear()
        some, chars = [], 0
        while at + len(some) < len(texts) and (not some or chars < BATCH_CHARS):
            some.append(lattices.words(texts[at + len(some)]))
            chars += sum(map(len, some[-1]))
        flat = [w for t in some for w in t]
        known: dict[str, int] = {}
        codes = np.array([known.setdefault(w, len(known)) for w in flat], dtype=np.int64)
        words = list(known)
        lattices.learn([w for w in words if w not in lattices.start])
        starts = np.fromiter(map(lattices.start.__getitem__, words), dtype=np.int64, count=len(words))[codes]
        hashed = [xxhash.xxh64_intdigest(str(x), seed) for x in keys[at : at + len(some)]]
        search = _Search(lattices.settle(), some, np.array(hashed, dtype=np.uint64), starts)
        turns = dict.fromkeys(range(len(some)), 0)
        for doc, path, own, threshold in search.run(k):
            log_prob, turns[doc] = float(path["log_prob"][own]), turns[doc] + 1
            score = 1.0 if threshold == -math.inf else -math.expm1(-math.exp(min(log_prob - threshold, 700.0)))
            out.append((at + doc, turns[doc], search.ids(path, own), log_prob, float(path["tops"][own]), score))
        # an empty text has one segmentation, which is empty
        out += [(at + d, 1, np.zeros(0, np.uint32), 0.0, 0.0, 1.0) for d, t in enumerate(some) if not t]
        at += len(some)
    return out


_lattices: dict[tuple, Lattices] = {}

COLUMNS = "doc_id {kind}, draw int, n_ids long, ids_crc32 long, log_prob double, perturbed double, inclusion double"


def sample_segmentations(
    docs: DataFrame,
    model: bytes,
    k: int = 2,
    smoothing: float = 1.0,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Up to ``k`` distinct segmentations of every text, a row each: ``doc_id, draw``
    (from 1, by falling perturbed value), ``n_ids, ids_crc32, log_prob, perturbed,
    inclusion``, if asked for ``ids`` (four bytes each, the lowest first), and the
    columns of ``docs`` named in ``keep``.

    ``smoothing`` scales the pieces' log probabilities. A text with fewer
    segmentations gives all of them, with an inclusion of 1; null and empty texts
    have one, the empty one. The draw depends on the id and ``seed`` alone, so
    repeated rows draw alike and ties in value do not arise. Joining the pieces of
    a draw gives the text. An empty table gives no rows; other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = COLUMNS.format(kind=kind) + (", ids binary" if with_ids else "")
    schema += "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = (zlib.crc32(shared.value), smoothing)
        if own not in _lattices:
            _lattices.clear()
            _lattices[own] = Lattices(shared.value, smoothing)
        for batch in _slices(batches, 1, BATCH_CHARS):
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = draw(_lattices[own], texts, keys, k, seed)
            blobs = [r[2].astype("<u4").tobytes() for r in rows]
            at = pa.array([r[0] for r in rows], pa.int64())
            columns = [
                batch.column(0).take(at),
                pa.array([r[1] for r in rows], pa.int32()),
                pa.array([len(r[2]) for r in rows], pa.int64()),
                pa.array([zlib.crc32(b) for b in blobs], pa.int64()),
                *(pa.array([r[i] for r in rows], pa.float64()) for i in (3, 4, 5)),
            ]
            names = ["doc_id", "draw", "n_ids", "ids_crc32", "log_prob", "perturbed", "inclusion"]
            if with_ids:
                columns, names = [*columns, pa.array(blobs, pa.binary())], [*names, "ids"]
            columns += [batch.column(2 + i).take(at) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(columns, [*names, *keep])

    return docs.select(id_col, F.col(text_col).cast("string").alias("_t"), *keep).mapInArrow(work, schema)


def _slices(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``most`` bytes in ``column``, or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


class Decoder:
    """The bytes that each id of a vocabulary stands for."""

    def __init__(self, model: bytes) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes.append(bytes([int(piece[3:-1], 16)]))
            elif sp.is_control(i):
                self.bytes.append(b"")
            else:
                self.bytes.append(sp.decode([sp.unk_id()]).encode() if sp.is_unknown(i) else piece.replace(SPACE, " ").encode())

        self.pieces = pa.array(self.bytes, pa.binary())

    def texts(self, ids: pa.Array) -> pa.Array:
        """The text of each row's id bytes, without the space set before every text."""
        rows = [b"" if x is None else x for x in ids.to_pylist()]
        ends = np.cumsum([0, *(len(x) // 4 for x in rows)], dtype=np.int64)
        pieces = self.pieces.take(pa.array(np.frombuffer(b"".join(rows), "<u4")))
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), pieces), b"").to_pylist()
        known = ids.is_valid().to_pylist()
        return pa.array(
            [t.removeprefix(b" ").decode("utf-8", "replace") if k else None for t, k in zip(joined, known)], pa.string()
        )


_decoders: dict[int, Decoder] = {}


def decode_segmentations(rows: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of the ids in ``ids_col``, as ``sample_segmentations``
    gives them, in a new last column; null ids give a null text. Narrow."""
    spark = prepare(rows.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    at = rows.columns.index(ids_col)
    schema = StructType([*rows.schema.fields, StructField(text_col, StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = zlib.crc32(shared.value)
        if own not in _decoders:
            _decoders.clear()
            _decoders[own] = Decoder(shared.value)
        for batch in _slices(batches, at, 4 * BATCH_CHARS):
            names = [*batch.schema.names, text_col]
            yield pa.RecordBatch.from_arrays([*batch.columns, _decoders[own].texts(batch.column(at))], names)

    return rows.mapInArrow(work, schema)


def decode_ids(ids, model: bytes) -> str:
    """The text of a segmentation."""
    return sentencepiece.SentencePieceProcessor(model_proto=model).decode([int(i) for i in ids])

"""SentencePiece sampling without replacement: perturbed A* over the lattice of a text; decoding."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Bytes of text whose lattices a task holds at a time, on average.
CHUNK_BYTES = 2 << 20
#: Atoms whose lattice a worker keeps.
COMMON_ATOMS = 40_000
#: Inverse temperature of the piece weights.
SHARPNESS = 0.5
_STEP, _LANE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) from 64-bit ones."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Vocabulary:
    """Pieces of a model as a byte trie, with log-weights.

    A unigram model's scores are log-probabilities. A BPE model's are merge
    ranks r, read as Zipf's law, -log(r + 2). Both are multiplied by
    `sharpness`. A space is the piece mark. Where no piece goes on with a
    space after anything else, no segmentation has a piece across the start
    of a run of spaces, so a text's lattice falls apart there, and nothing of
    it is lost; the same goes for line ends. A model with such pieces gets
    lattices of whole lines or texts.
    """

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        scores = np.array([model.get_score(i) for i in range(n)])
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        texts = {i: model.id_to_piece(i).replace("▁", " ").encode() for i in plain}
        ranked = all(scores[i] == int(scores[i]) for i in plain[:100])
        self.weight = (np.where(scores > -1e8, -np.log(np.maximum(-scores, 0) + 2), -60.0) if ranked else scores) * sharpness
        self.byte = np.array([next((i for i in [model.piece_to_id(f"<0x{b:02X}>")] if model.is_byte(i)), model.unk_id()) for b in range(256)])
        self.byte_weight = -math.log(n + 2) * sharpness
        self.bytes = [texts.get(i, b"") for i in range(n)]
        for b in range(256):
            if model.is_byte(int(self.byte[b])):
                self.bytes[self.byte[b]] = bytes([b])
        self.lengths = np.array([len(x) for x in self.bytes])
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths
        nodes: list[dict[int, int]] = [{}]
        ends: list[dict[int, int]] = [{}]
        splits_lines = splits_words = True
        for i, piece in texts.items():
            splits_lines &= b"\n" not in piece
            splits_words &= not re.search(rb"[^ ] ", piece)
            at = 0
            for b in piece[:-1]:
                if b not in nodes[at]:
                    nodes[at][b] = len(nodes)
                    nodes.append({})
                    ends.append({})
                at = nodes[at][b]
            ends[at][piece[-1]] = i
        self.next, self.piece = (np.full((len(nodes), 256), -1, np.int32) for _ in range(2))
        for at, (inner, last) in enumerate(zip(nodes, ends)):
            for b, to in inner.items():
                self.next[at, b] = to
            for b, i in last.items():
                self.piece[at, b] = i
        self.common: dict[str, int] = {}  # atoms whose lattice a worker keeps, from the first texts that it sees
        self.shared: Lattice | None = None
        inner = (r"[^ \n]" if splits_words else r"[^\n]") if splits_lines else r"[^ ]" if splits_words else r"(?s:.)"
        self.atoms = re.compile(rf" *{inner}+| +|\n")

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the pieces in a row, without the leading mark."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        if not len(ends) or not ends[-1]:
            return b""
        at = np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1])
        return self.flat[at].tobytes()[1:]


@cache
def vocabulary(path: str, sharpness: float) -> Vocabulary:
    return Vocabulary(path, sharpness)


class Lattice(NamedTuple):
    """Edges by the node they start from, likeliest first; nodes are bytes of the atoms, one more ends each."""

    root: np.ndarray  # of each atom
    first: np.ndarray  # edge of each node; one more at the end
    piece: np.ndarray
    end: np.ndarray
    logp: np.ndarray  # given the start
    cum: np.ndarray  # of probabilities within the start; infinite at the last


def lattice(vocab: Vocabulary, atoms: list[str]) -> Lattice:
    """All segmentations of each atom, with the exact probability of each edge given its start (backward masses)."""
    encoded = [a.encode("utf-8", "surrogatepass") for a in atoms]
    raw = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
    sizes = np.array([len(e) for e in encoded], np.int64)
    root = np.cumsum(sizes + 1) - sizes - 1
    left = np.repeat(root + sizes, sizes + 1) - np.arange(len(raw))  # bytes up to the atom's end
    lead = ((raw & 0xC0) != 0x80) & (left > 0)
    width = np.where(raw < 0x80, 1, np.where(raw < 0xE0, 2, np.where(raw < 0xF0, 3, 4)))
    # Nodes are numbered by the bytes left, so that the edges of a level lie together and masses build up level by level.
    by_left = np.argsort(left.astype(np.uint16) if left.max(initial=0) < 65536 else left, kind="stable")
    number = np.empty(len(raw), np.int64)
    number[by_left] = np.arange(len(raw))
    start = np.flatnonzero(lead)
    node, depth = np.zeros(len(start), np.int32), 0
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    single, degree = np.zeros(len(raw), bool), np.zeros(len(raw), np.int64)

    def put(begin: np.ndarray, end: np.ndarray, piece: np.ndarray) -> None:
        found.append((begin, end, piece, degree[begin]))
        degree[begin] += 1

    live = start
    while len(live):
        b = raw[live + depth]
        hit = vocab.piece[node, b]
        ok = hit >= 0
        put(live[ok], live[ok] + depth + 1, hit[ok])
        single[live[ok & (width[live] == depth + 1)]] = True
        node = vocab.next[node, b]
        depth += 1
        more = (node >= 0) & (left[live] > depth)
        live, node = live[more], node[more]
    trie = sum(len(f[0]) for f in found)
    bare = start[~single[start]]
    for d in range(4):  # a character without a piece of its own: its bytes
        own = bare[(width[bare] > d) & (left[bare] > d)] + d
        put(own, own + 1, vocab.byte[raw[own]].astype(np.int32))
    begin, end, piece, rank = (np.concatenate([f[i] for f in found]) for i in range(4))
    weight = vocab.weight[piece]
    weight[trie:] = vocab.byte_weight
    degree = degree[by_left]
    first = np.concatenate([[0], np.cumsum(degree)])
    begin, end = number[begin], number[end]
    at = first[begin + 1] - 1 - rank  # longest first
    out = lambda x: (y := np.empty_like(x), y.__setitem__(at, x))[0]
    begin, end, piece, weight, rank = out(begin), out(end), out(piece), out(weight), out(degree[begin] - 1 - rank)
    beta, total = np.zeros(len(raw)), np.empty(len(begin))
    levels = np.searchsorted(left[by_left], np.arange(1, left.max(initial=0) + 2))
    for a, z in zip(levels, levels[1:]):
        p, q = first[a], first[z]
        total[p:q] = weight[p:q] + beta[end[p:q]]
        busy = np.flatnonzero(degree[a:z]) + a
        if len(busy):
            beta[busy] = np.logaddexp.reduceat(total[p:q], first[busy] - p)
    logp = total - beta[begin]
    cum = np.exp(logp)
    for r in range(1, int(degree.max(initial=1))):
        own = np.flatnonzero(rank == r) if r == 1 else own[rank[np.minimum(own + 1, len(rank) - 1)] == r] + 1
        cum[own] += cum[own - 1]
    cum[first[1:][degree > 0] - 1] = np.inf
    return Lattice(number[root], first, piece, end, logp, cum)


def joined(one: Lattice, two: Lattice) -> Lattice:
    """Both, the atoms of the second after those of the first."""
    nodes, edges = len(one.first) - 1, len(one.piece)
    cat = lambda a, b: np.concatenate([a, b])
    return Lattice(cat(one.root, two.root + nodes), cat(one.first[:-1], two.first + edges), cat(one.piece, two.piece), cat(one.end, two.end + nodes), cat(one.logp, two.logp), cat(one.cum, two.cum))


def _walk(lat: Lattice, node: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ancestral samples from nodes to their atoms' ends, side by side: edges in a row, and how many each has."""
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    live, here, count = np.arange(len(node)), node, np.zeros(len(node), np.int64)
    while len(live := live[more := lat.first[here + 1] > lat.first[here]]):
        edge = lat.first[here[more]]
        u = _unit(_mix(seed[live] + np.uint64((len(steps) + 1) * int(_STEP) % 2**64)))
        late = np.flatnonzero(u >= lat.cum[edge])
        while len(late):
            edge[late] += 1
            late = late[u[late] >= lat.cum[edge[late]]]
        steps.append((live, edge))
        count[live] += 1
        here = lat.end[edge]
    at = np.cumsum(count) - count
    out = np.empty(int(count.sum()), np.int64)
    for t, (own, edge) in enumerate(steps):
        out[at[own] + t] = edge
    return out, count


def _below(phi: float, bound: float, u: float) -> float:
    """A Gumbel number with location phi, given that it is at most `bound`."""
    return phi - math.log(math.exp(min(phi - bound, 700.0)) - math.log(u)) if phi - bound < 700 else bound


def _rest_mass(logp: float) -> float:
    """log(1 - exp(logp)); minus infinity at 0."""
    return -math.inf if logp >= 0 else math.log(-math.expm1(logp)) if logp < -1e-300 else -math.inf


class Sample(NamedTuple):
    edges: np.ndarray
    logp: float
    gumbel: float


def _search(lat: Lattice, roots: np.ndarray, walks: list[tuple[np.ndarray, np.ndarray]], logps: list[float], seed: int, k: int) -> tuple[list[Sample], float]:
    """Top-down A* over perturbed sets of segmentations of one text; the best value left over is the threshold.

    walks: an ancestral sample of the whole text for each of the k, as its
    edges and the edges each atom has. A set is either all segmentations that
    start with given edges, or those that share d edges of a sample and leave
    it later. Its value is the largest Gumbel-perturbed log-probability
    within, so the highest set popped holds the next sample; the best of a
    set is an ancestral sample of it, whatever its value.
    """
    stream = iter(range(1, 1 << 62))

    def draw() -> float:
        return (xxhash.xxh64_intdigest(next(stream).to_bytes(8, "little"), seed) >> 11) * 2.0**-53 + 2.0**-54

    best = -math.log(-math.log(draw()))
    samples = [Sample(walks[0][0], logps[0], best)]
    heap: list = []
    ties = iter(range(1 << 62))

    def leave(path: Sample, depth: int, before: float, bound: float) -> None:
        """The set of those that share `depth` edges of a path, of log-probability `before`, and leave it later."""
        mass = before + _rest_mass(min(path.logp - before, 0.0)) if (lat.logp[path.edges[depth:]] < 0).any() else -math.inf
        if mass > -math.inf:
            heapq.heappush(heap, (-_below(mass, bound, draw()), next(ties), path, depth, before, None))

    leave(samples[0], 0, 0.0, best)
    while heap and len(samples) < k:
        value, _, path, depth, before, edge = heapq.heappop(heap)
        value = -value
        if edge is None:
            # Split by the edge at this depth: the best of the parts keeps the value, the others fall below it.
            node = _node(lat, roots, path.edges, depth)
            own = int(path.edges[depth])
            parts = [(before + float(lat.logp[e]), e) for e in range(int(lat.first[node]), int(lat.first[node + 1])) if e != own]
            ahead = before + float(lat.logp[own])
            rest = ahead + _rest_mass(min(path.logp - ahead, 0.0)) if (lat.logp[path.edges[depth + 1 :]] < 0).any() else -math.inf
            if rest > -math.inf:
                parts.append((rest, None))
            top = max(m for m, _ in parts)
            shares = [math.exp(m - top) for m, _ in parts]
            u, chosen = draw() * sum(shares), 0
            while chosen < len(parts) - 1 and u >= shares[chosen]:
                u -= shares[chosen]
                chosen += 1
            for i, (mass, e) in enumerate(parts):
                v = value if i == chosen else _below(mass, value, draw())
                heapq.heappush(heap, (-v, next(ties), path, depth + (e is None), ahead if e is None else mass, e))
            continue
        # The best of all that start with these edges: the rest of the atom anew, further atoms from this sample's own walk.
        made = [*path.edges[:depth].tolist(), edge]
        node = int(lat.end[edge])
        while lat.first[node + 1] > lat.first[node]:
            e, u = int(lat.first[node]), draw()
            while u >= lat.cum[e]:
                e += 1
            made.append(e)
            node = int(lat.end[e])
        done = _atoms_done(lat, made)
        later, counts = walks[len(samples)]
        edges = np.concatenate([np.array(made, np.int64), later[int(counts[:done].sum()) :]])
        sample = Sample(edges, float(lat.logp[edges].sum()), value)
        samples.append(sample)
        leave(sample, depth + 1, before, value)
    return samples, -heap[0][0] if heap else -math.inf


def _atoms_done(lat: Lattice, edges: list[int]) -> int:
    ends = lat.end[edges]
    return int((lat.first[ends + 1] == lat.first[ends]).sum())


def _node(lat: Lattice, roots: np.ndarray, edges: np.ndarray, depth: int) -> int:
    if depth == 0:
        return int(roots[0])
    end = int(lat.end[edges[depth - 1]])
    if lat.first[end + 1] > lat.first[end]:
        return end
    return int(roots[_atoms_done(lat, edges[:depth].tolist())])


def inclusion(logp: float, threshold: float) -> float:
    """Log of the chance that a segmentation's Gumbel number passes the threshold."""
    if threshold == -math.inf:
        return 0.0
    gap = logp - threshold
    return gap if gap < -30 else math.log(-math.expm1(-math.exp(min(gap, 700.0))))


def segmentations(vocab: Vocabulary, texts: list[str], seeds: list[int], k: int) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text up to k distinct segmentations: (ids, log-probability, log-inclusion), best perturbed first."""
    split = [vocab.atoms.findall(" " + t) for t in texts]
    flat = [a for atoms in split for a in atoms]
    if not vocab.common:
        counts = Counter(flat).most_common(COMMON_ATOMS)
        vocab.common.update((a, i) for i, (a, n) in enumerate(counts) if n > 1 and len(a) < 24)
        vocab.shared = lattice(vocab, list(vocab.common))
    rare = [a for a in dict.fromkeys(flat) if a not in vocab.common]
    known = vocab.common | {a: i for i, a in enumerate(rare, len(vocab.common))}
    lat = joined(vocab.shared, lattice(vocab, rare))
    roots = lat.root[np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))]
    n = np.array([len(a) for a in split], np.int64)
    text = np.repeat(np.arange(len(texts)), n)
    place = (np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64)
    base = np.array(seeds, np.uint64)[text]
    cuts = np.concatenate([[0], np.cumsum(n)])
    walks, logps, bounds = [], [], []
    for j in range(k):
        edges, count = _walk(lat, roots, _mix(base + np.uint64((j + 1) * int(_LANE) % 2**64)) + _mix(place * _STEP + np.uint64(j)))
        at = np.concatenate([[0], np.cumsum(count)])
        walks.append((edges, count))
        bounds.append(at[cuts])
        logps.append(np.bincount(np.repeat(text, count), weights=lat.logp[edges], minlength=len(texts)))
    out = []
    for i in range(len(texts)):
        own = [(e[b[i] : b[i + 1]], c[cuts[i] : cuts[i + 1]]) for (e, c), b in zip(walks, bounds)]
        samples, threshold = _search(lat, roots[cuts[i] : cuts[i + 1]], own, [float(p[i]) for p in logps], seeds[i], k)
        out.append([(lat.piece[s.edges], s.logp, inclusion(s.logp, threshold)) for s in samples])
    return out


def sample_pieces(docs: DataFrame, path: str, k: int = 2, seed: int = 0, sharpness: float = SHARPNESS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Up to k rows a document: (key, sample, ids, n_pieces, log_prob, log_inclusion, restored).

    The samples of a text are drawn without replacement from all its
    segmentations, with Gumbel numbers seeded by the row's key and `seed`:
    results don't depend on how rows are dealt out. sample counts from 1, the
    highest perturbed log-probability first; log_inclusion is the log of the
    chance to be above the best one left out. A text's walks are held whole,
    about 50 bytes of memory a byte of text and sample. ids are little-endian unsigned
    32-bit numbers. restored: decoding gives the text back. Whole texts of
    any length are segmented; one with fewer segmentations has all of them.
    Null texts count as empty, which is the piece mark alone. Rows of one key
    and text get equal samples; null keys count as one. No rows, no result;
    other columns are ignored.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, sharpness)
        for batch in batches:
            for part in slices([batch], 1, CHUNK_BYTES):
                texts = [x or "" for x in part.column(1).to_pylist()]
                seeds = [xxhash.xxh64_intdigest(str(x), seed) for x in part.column(0).to_pylist()]
                row, sample, ids, size, logp, chance, same = [], [], [], [], [], [], []
                for i, found in enumerate(segmentations(vocab, texts, seeds, k)):
                    raw = texts[i].encode("utf-8", "surrogatepass")
                    for j, (pieces, lp, inc) in enumerate(found):
                        row.append(i)
                        sample.append(j + 1)
                        ids.append(pieces.astype("<u4").tobytes())
                        size.append(len(pieces))
                        logp.append(lp)
                        chance.append(inc)
                        same.append(vocab.decode(pieces) == raw)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(sample, pa.int32()), pa.array(ids, pa.binary()), pa.array(size, pa.int64()), pa.array(logp, pa.float64()), pa.array(chance, pa.float64()), pa.array(same, pa.bool_())],
                    names=["key", "sample", "ids", "n_pieces", "log_prob", "log_inclusion", "restored"],
                )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(draw, f"key {kind}, sample int, ids binary, n_pieces bigint, log_prob double, log_inclusion double, restored boolean").withColumnRenamed("key", key)


def decode_pieces(rows: DataFrame, path: str, ids: str = "ids", to: str = "text") -> DataFrame:
    """rows with the text of their ids, which are as sample_pieces() gives them. Null ids give null; a clashing column is replaced."""
    from pyspark.sql import types as T

    @F.pandas_udf(T.StringType())
    def decode(parts):  # noqa: ANN001, ANN202
        vocab = vocabulary(path, SHARPNESS)
        return parts.map(lambda raw: None if raw is None else vocab.decode(np.frombuffer(raw, "<u4").astype(np.int64)).decode("utf-8", "replace"))

    return rows.withColumn(to, decode(F.col(ids)))

"""Weighted acyclic automata over 64-bit labels, in numpy: count transducers of phrases.

A transducer is a list of layers.  A layer has states and, for each state, arcs in label
order; an arc carries the count of the phrase that ends with it (0 if none does) and leads
to a state of the next layer.  States with equal arcs are one state, so the automaton is
minimal for its counts.  The phrase of a path is the sequence of its labels.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from stockweave.llm import hashing


@dataclass
class Layer:
    """``first[s]:first[s + 1]`` are the arcs of state s."""

    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray


def _expand(first: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Arcs of each state in turn: (index into states, arc)."""
    degree = first[states + 1] - first[states]
    owner = np.repeat(np.arange(len(states)), degree)
    start = np.cumsum(degree) - degree
    return owner, np.arange(len(owner)) - np.repeat(start, degree) + np.repeat(first[states], degree)


def _grouped(code: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes in order, the sum of the weights of each, and the place of each row."""
    if not len(code):
        return code, weight, np.zeros(0, np.int64)
    order = np.argsort(code, kind="stable")
    ordered = code[order]
    head = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    place = np.empty(len(code), np.int64)
    place[order] = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(code)]))
    return ordered[head], np.add.reduceat(weight[order], head), place


def _codes(group: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One integer for each (group, label), in that order, and the distinct labels."""
    labels, rank = np.unique(label, return_inverse=True)
    return group.astype(np.int64) * max(1, len(labels)) + rank, labels


def build(phrases: list[np.ndarray], weights: list[np.ndarray], ranges: np.ndarray, prefix: int) -> list[tuple[int, list[Layer]]]:
    """Count transducers of a shard, one for each prefix range: (range, layers).

    ``phrases`` has a matrix for each phrase length, one row a phrase, and ``weights`` the
    counts of its rows.  ``ranges`` are the lower ends of the prefix ranges over the hash of
    the first ``prefix`` labels.  The phrases are sorted; where a phrase leaves the path of
    the one before, new arcs begin, and what lies behind is finished: going up from the last
    layer, a finished state is looked up among the equal ones of its range.
    """
    depth = max((p.shape[1] for p in phrases if len(p)), default=0)
    total = sum(len(p) for p in phrases)
    if not total:
        return []
    label = np.zeros((total, depth), np.uint64)
    length = np.concatenate([np.full(len(p), p.shape[1]) for p in phrases])
    at = 0
    for p in phrases:
        label[at : at + len(p), : p.shape[1]] = p[:, :depth]
        at += len(p)
    weight = np.concatenate(weights).astype(np.int64)
    part = np.searchsorted(ranges, hashing.mix(prefix_hash(label, prefix)), side="right") - 1
    # the layers of the prefix tree, the range being the label before the first
    nodes, node = np.unique(part, return_inverse=True)
    own, rows = [], np.arange(total)
    parts, tree = nodes, []
    for d in range(depth):
        live = length[rows] > d
        rows, node = rows[live], node[live]
        code, labels = _codes(node, label[rows, d])
        code, sums, place = _grouped(code, np.where(length[rows] == d + 1, weight[rows], 0))
        parent = code // max(1, len(labels))
        tree.append((parent, labels[code % max(1, len(labels))], sums))
        own.append(own[-1][parent] if own else parent)
        node = place
    # from the last layer up: equal states of a range become one
    target = np.zeros(len(tree[-1][0]), np.int64)
    out: list[tuple] = []
    for d in range(depth - 1, -1, -1):
        parent, labels, sums = tree[d]
        states = len(own[d - 1]) if d else len(nodes)
        first = np.searchsorted(parent, np.arange(states + 1))
        if not d:
            out.append((first, labels, sums, target, parts))
            break
        merged = _equal_states(first, labels, sums, target, own[d - 1])
        kept = np.flatnonzero(merged == np.arange(states))
        owner, arcs = _expand(first, kept)
        degree = np.bincount(owner, minlength=len(kept))
        out.append((np.r_[0, np.cumsum(degree)], labels[arcs], sums[arcs], target[arcs], own[d - 1][kept]))
        target = np.searchsorted(kept, merged)
    out.reverse()
    return [(int(parts[k]), _slice(out, k)) for k in range(len(parts))]


def prefix_hash(label: np.ndarray, prefix: int) -> np.ndarray:
    value = np.zeros(len(label), np.uint64)
    for j in range(min(prefix, label.shape[1])):
        value = value * np.uint64(hashing.BASE) + label[:, j]
    return value


def _equal_states(first, label, weight, target, own) -> np.ndarray:
    """For each state the first one of its range with the same arcs."""
    states = len(first) - 1
    owner = np.repeat(np.arange(states), np.diff(first))
    seed = label ^ hashing.mix(weight.astype(np.uint64) * np.uint64(hashing.BASE) + target.astype(np.uint64))
    sums = np.zeros(states, np.uint64)
    np.add.at(sums, owner, hashing.mix(seed))
    sums = hashing.mix(sums ^ hashing.mix(own.astype(np.uint64) + np.uint64(1)))
    _, lead, place = np.unique(sums, return_index=True, return_inverse=True)
    merged = lead[place]
    # the hash only proposes: arcs are compared one by one
    again = np.flatnonzero(merged != np.arange(states))
    same = (np.diff(first)[again] == np.diff(first)[merged[again]]) & (own[again] == own[merged[again]])
    again = np.r_[again[same], again[~same]]
    equal = np.zeros(len(again), bool)
    checked = again[: same.sum()]
    o, mine = _expand(first, checked)
    _, theirs = _expand(first, merged[checked])
    differs = (label[mine] != label[theirs]) | (weight[mine] != weight[theirs]) | (target[mine] != target[theirs])
    equal[: len(checked)] = np.bincount(o[differs], minlength=len(checked)) == 0
    merged[again[~equal]] = again[~equal]
    return merged


def _slice(layers: list[tuple], k: int) -> list[Layer]:
    """The transducer of the k-th range; each layer holds its states side by side."""
    out, low, high = [], k, k + 1
    for d, (first, label, weight, target, own) in enumerate(layers):
        if d:
            low, high = np.searchsorted(own, k), np.searchsorted(own, k, side="right")
        a, b = first[low], first[high]
        base = np.searchsorted(layers[d + 1][4], k) if d + 1 < len(layers) else 0
        out.append(Layer(first[low : high + 1] - a, label[a:b], weight[a:b], target[a:b] - base if d + 1 < len(layers) else target[a:b]))
    return out


def pack(layers: list[Layer]) -> bytes:
    """Bytes of a transducer; each array takes the narrowest type that holds it."""
    parts = [struct.pack("<B", len(layers))]
    for layer in layers:
        for array in (np.diff(layer.first), layer.label, layer.weight, layer.target):
            kind = np.dtype(np.uint64) if array.dtype == np.uint64 else np.min_scalar_type(int(array.max(initial=0)))
            parts += [struct.pack("<BI", kind.itemsize, len(array)), array.astype(kind).tobytes()]
    return b"".join(parts)


_TYPES = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}


def unpack(data: bytes) -> list[Layer]:
    layers, at = [], 1
    for _ in range(data[0]):
        arrays = []
        for _ in range(4):
            size, n = struct.unpack_from("<BI", data, at)
            arrays.append(np.frombuffer(data, _TYPES[size], n, at + 5))
            at += 5 + size * n
        degree, label, weight, target = arrays
        layers.append(Layer(np.r_[0, np.cumsum(degree, dtype=np.int64)], label.astype(np.uint64), weight.astype(np.int64), target.astype(np.int64)))
    return layers


def union(transducers: list[list[Layer]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sum of transducers: for each layer (parent, label, weight) of its arcs in order, where
    parent is the arc of the layer before.  All states that one path reaches in the different
    automata are followed together, and the weights of equal arcs are added."""
    depth = max((len(t) for t in transducers), default=0)
    out = []
    live = list(transducers)
    group, state = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64)
    origin = np.arange(len(live))
    for d in range(depth):
        base, first, columns = [], [np.zeros(1, np.int64)], ([], [], [])
        states = arcs = 0
        for t in transducers:
            base.append(states)
            if d < len(t):
                layer = t[d]
                first.append(layer.first[1:] + arcs)
                states += len(layer.first) - 1
                arcs += len(layer.label)
                for column, array in zip(columns, (layer.label, layer.weight, layer.target)):
                    column.append(array)
        if not arcs:
            break
        first = np.concatenate(first)
        label, weight, target = (np.concatenate(c) for c in columns)
        has = np.array([d < len(t) for t in transducers])[origin]
        group, state, origin = group[has], state[has], origin[has]
        owner, at = _expand(first, state + np.array(base)[origin])
        code, labels = _codes(group[owner], label[at])
        code, sums, place = _grouped(code, weight[at])
        out.append((code // max(1, len(labels)), labels[code % max(1, len(labels))], sums))
        group, state, origin = place, target[at], origin[owner]
    return out


def paths(layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]], least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length the phrases with at least this count: (matrix of labels, counts)."""
    out = []
    for d, (_, _, weight) in enumerate(layers):
        at = np.flatnonzero(weight >= least)
        counts, columns = weight[at], []
        for e in range(d, -1, -1):
            columns.append(layers[e][1][at])
            at = layers[e][0][at]
        out.append((np.stack(columns[::-1], axis=1) if columns else np.zeros((0, d + 1), np.uint64), counts))
    return out


def compose(counts: list[Layer], wanted: list[Layer]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Look up the phrases of ``wanted`` in ``counts``: pairs of states are followed along
    equal labels; for each length (matrix of labels, counts) of the phrases both hold."""
    out, left, right = [], np.zeros(1, np.int64), np.zeros(1, np.int64)
    trail: list[np.ndarray] = []
    for a, b in zip(counts, wanted):
        own_a, arc_a = _expand(a.first, left)
        own_b, arc_b = _expand(b.first, right)
        code, _ = _codes(np.r_[own_a, own_b], np.r_[a.label[arc_a], b.label[arc_b]])
        _, i, j = np.intersect1d(code[: len(arc_a)], code[len(arc_a) :], assume_unique=True, return_indices=True)
        trail = [t[own_a[i]] for t in trail] + [a.label[arc_a[i]]]
        asked = b.weight[arc_b[j]] > 0
        out.append((np.stack([t[asked] for t in trail], axis=1), a.weight[arc_a[i]][asked]))
        left, right = a.target[arc_a[i]], b.target[arc_b[j]]
    return out

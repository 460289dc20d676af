"""Cover trees over blocks of points: whole subtrees are assigned to their nearest entry by the triangle inequality."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: A node of so many points is not divided further.
LEAF = 8
#: Whole numbers up to this size have squared distances that fit 64 bits in up to 8192 dimensions; larger ones are Python's integers.
SMALL = 1 << 24
#: What rounding may do to a distance, on the safe side.
SLACK = 1e-9


def exact(points: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """The arrays as 64-bit integers where squares of their differences fit, else as Python's integers."""
    arrays = (points, *others)
    if all(a.size == 0 or (a.max() <= SMALL and a.min() >= -SMALL) for a in arrays):
        return tuple(a.astype(np.int64) for a in arrays)
    return tuple(a.astype(object) for a in arrays)


def ranges(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The whole numbers of [begin, end), one range after another."""
    sizes = ends - begins
    total = int(sizes.sum())
    return np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)


def row_squares(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The squared distance of each row to the other one in its place, exact."""
    apart = points - others
    return (apart * apart).sum(axis=1) if apart.dtype == object else np.einsum("ij,ij->i", apart, apart)


@dataclass
class CoverTree:
    """Points in such an order that each subtree is a range of them.

    Node i covers points[low[i]:high[i]], none of which is further than radius[i] from its centre points[centre[i]]. Its children are
    the nodes first[i]:last[i]; the centre of a node is the centre of its first child too, centres of siblings are more than half the
    node's radius apart, and each point belongs to a child within half that radius. Nodes are listed by depth.
    """

    points: np.ndarray
    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def sums(self) -> np.ndarray:
        """Cumulative sums of the points, so that those of a subtree are one difference."""
        wide = self.points if self.points.dtype == object or len(self.points) < 1 << 20 else self.points.astype(object)
        if wide.dtype != object and wide.size and max(int(wide.max()), -int(wide.min())) > 1 << 40:
            wide = wide.astype(object)
        return np.concatenate([np.zeros((1, wide.shape[1]), dtype=wide.dtype), np.cumsum(wide, axis=0)])


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    apart = points - centres
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> CoverTree:
    """The tree of all points of a block, made level by level.

    In all nodes of a level at once, the point that is furthest from the centres so far becomes the next centre, until none is
    further than half the node's radius.
    """
    count = len(points)
    real = points.astype(np.float64)
    order = np.arange(count)
    apart = _distances(real, real[:1])
    low, high, centre, radius = [np.array([0])], [np.array([count])], [np.array([0])], [np.array([apart.max() if count else 0.0])]
    first, last = [], []
    # The nodes of this level, and of each place of the order the distance to the centre of its node.
    begin, end, head, reach = low[0], high[0], centre[0], radius[0]
    made = 1
    while len(begin):
        divided = (end - begin > leaf) & (reach > 0)
        first.append(np.full(len(begin), made))
        last.append(np.full(len(begin), made))
        places = ranges(begin[divided], end[divided])
        if not len(places):
            break
        sizes = (end - begin)[divided]
        node = np.repeat(np.arange(len(sizes)), sizes)
        bounds = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        members = order[places]
        near = _distances(real[members], real[head[divided]][node])
        chosen = [head[divided]]
        child = np.zeros(len(members), dtype=np.int64)
        half = reach[divided] / 2
        active = np.arange(len(sizes))
        picks = 1
        # Members and nodes that still have a point too far from all centres.
        part, part_node, part_bounds = np.arange(len(members)), node, bounds
        while True:
            furthest = np.maximum.reduceat(near[part], part_bounds)
            open_ = furthest > half[active]
            if not open_.any():
                break
            keep = np.repeat(open_, np.diff(np.append(part_bounds, len(part))))
            part = part[keep]
            active, furthest = active[open_], furthest[open_]
            counts = sizes[active]
            part_bounds = np.concatenate([[0], np.cumsum(counts)[:-1]])
            part_node = np.repeat(np.arange(len(active)), counts)
            is_furthest = np.flatnonzero(near[part] == furthest[part_node])
            one = is_furthest[np.flatnonzero(np.diff(part_node[is_furthest], prepend=-1))]
            heads = np.full(len(sizes), -1)
            heads[active] = members[part[one]]
            chosen.append(heads)
            far = _distances(real[members[part]], real[heads[active]][part_node])
            closer = far < near[part]
            near[part[closer]] = far[closer]
            child[part[closer]] = picks
            picks += 1
        # Members by node and child; a child's first member need not be its centre.
        place = np.lexsort((child, node))
        order[places] = members[place]
        key = node[place] * picks + child[place]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        stops = np.append(starts[1:], len(key))
        heads = np.stack(chosen)[child[place][starts], node[place][starts]]
        spread = np.maximum.reduceat(near[place], starts)
        per_node = np.bincount(node[place][starts], minlength=len(sizes))
        ends = made + np.cumsum(per_node)
        first[-1][divided], last[-1][divided] = ends - per_node, ends
        made += len(starts)
        shift = places[starts]
        begin, end, head, reach = shift, shift + (stops - starts), heads, spread
        low.append(begin)
        high.append(end)
        centre.append(head)
        radius.append(reach)
    nodes = lambda parts: np.concatenate(parts)
    where = np.empty(count, dtype=np.int64)
    where[order] = np.arange(count)
    return CoverTree(points[order], order, nodes(low), nodes(high), where[nodes(centre)] if count else np.zeros(1, int), nodes(radius), nodes(first), nodes(last))


@dataclass
class Assigned:
    """The entry of each point in the tree's order, counts and sums by entry, and how many points were decided by their subtree."""

    entry: np.ndarray
    counts: np.ndarray
    sums: np.ndarray
    by_subtree: int


def assign(tree: CoverTree, entries: np.ndarray) -> Assigned:
    """The nearest entry of every point, equals to the lower index, exact.

    A node of radius r whose centre is nearest to entry a, at distance d, cannot have a point nearer to an entry that is further than
    d + 2r. Where only a is left, all points of the subtree are a's and its sums come from the cumulative ones; otherwise
    the children go on with the entries left, and the points of a leaf are compared exactly.
    """
    points, entries = exact(tree.points, entries)
    total = len(points)
    entry = np.zeros(total, dtype=np.int64)
    counts = np.zeros(len(entries), dtype=np.int64)
    cumulative = tree.sums()
    sums = np.zeros(entries.shape, dtype=cumulative.dtype)
    # Of equal entries only the first can be a nearest one.
    _, distinct = np.unique(entries.astype(str) if entries.dtype == object else entries, axis=0, return_index=True)
    alone = np.zeros(len(entries), dtype=bool)
    alone[distinct] = True
    real, wanted = points.astype(np.float64), entries.astype(np.float64)
    by_subtree = 0
    # Pairs of a node and an entry that may be the nearest of one of its points, by node and then by entry.
    nodes, size, pair = np.array([0]), np.array([alone.sum()]), np.flatnonzero(alone)
    while len(nodes) and total:
        centres, reach = tree.centre[nodes], tree.radius[nodes]
        node = np.repeat(np.arange(len(nodes)), size)
        far = _distances(real[centres][node], wanted[pair])
        best = np.minimum.reduceat(far, np.cumsum(size) - size)
        keep = far * (1 - SLACK) <= ((best + 2 * reach) * (1 + SLACK))[node]
        pair, node = pair[keep], node[keep]
        size = np.bincount(node, minlength=len(nodes))
        begin = np.cumsum(size) - size
        # All points of a node without radius are its centre.
        point = (size > 1) & (reach == 0)
        decided = point | (size == 1)
        nearest = pair[begin]
        if point.any():
            nearest[point] = _nearest(points[centres[point]], entries, pair[ranges(begin[point], (begin + size)[point])], size[point])
        own, chosen = nodes[decided], nearest[decided]
        low, high = tree.low[own], tree.high[own]
        entry[ranges(low, high)] = np.repeat(chosen, high - low)
        np.add.at(counts, chosen, high - low)
        np.add.at(sums, chosen, cumulative[high] - cumulative[low])
        by_subtree += int((high - low).sum())

        leaf = ~decided & (tree.first[nodes] == tree.last[nodes])
        own = nodes[leaf]
        covered = tree.high[own] - tree.low[own]
        places = ranges(tree.low[own], tree.high[own])
        pairs = np.repeat(begin[leaf], covered), np.repeat((begin + size)[leaf], covered)
        chosen = _nearest(points[places], entries, pair[ranges(*pairs)], pairs[1] - pairs[0])
        entry[places] = chosen
        np.add.at(counts, chosen, 1)
        np.add.at(sums, chosen, points[places])

        down = ~decided & ~leaf
        own = nodes[down]
        children = tree.last[own] - tree.first[own]
        nodes = ranges(tree.first[own], tree.last[own])
        pair = pair[ranges(np.repeat(begin[down], children), np.repeat((begin + size)[down], children))]
        size = np.repeat(size[down], children)
    return Assigned(entry, counts, sums, by_subtree)


def _nearest(points: np.ndarray, entries: np.ndarray, pair: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The lowest index of the nearest entry of each point among the next size[i] of `pair`, exact."""
    if not len(points):
        return np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(points)), size)
    apart = row_squares(points[owner], entries[pair])
    begin = np.cumsum(size) - size
    least = np.minimum.reduceat(apart, begin)
    hit = np.flatnonzero(apart == least[owner])
    return pair[hit[np.flatnonzero(np.diff(owner[hit], prepend=-1))]]

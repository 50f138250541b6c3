"""The graph of one section's segments: ends welded to vertices, gaps that their own directions close, and its loops."""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np

from strataframe.functions.polygons import Point, Ring, hull, signed_area, smallest_box

#: Fixed values of straight seams: greatest product of the two directions, least products of each with the way to the other end.
OPPOSED, TOWARDS = -0.98, 0.70
#: Fixed values of corners: least sine between the directions, share of the straight run and least length that an end may be
#: lengthened by, share of the weld that it may be shortened by.
BENT, OF_RUN, AT_LEAST, BACK = 0.25, 0.15, 3.0, 0.25
#: Fixed value: a loop's least area.
LEAST_AREA = 0.1
#: Fixed value: so far beyond a bound a computed length still counts as the bound.
ROUNDING = 1e-9


@dataclass(frozen=True)
class OutlineParams:
    """weld: ends so near are one vertex. seam: longest gap closed straight on. corner_gap, corner_reach: longest gap that is closed by lengthening both
    ends, and by how much at most; 0 closes none. each: loops are taken part by part, and parts that branch or are open are counted."""

    weld: float = 0.6
    seam: float = 3.0
    corner_gap: float = 3.0
    corner_reach: float = 3.0
    each: bool = False


@dataclass
class Section:
    """vertices in order of their first use, the neighbours of each, and where the segment to a neighbour ends, if not at the vertex itself."""

    weld: float
    vertices: Ring = field(default_factory=list)
    near: list[set[int]] = field(default_factory=list)
    own: dict[tuple[int, int], Point] = field(default_factory=dict)
    cells: dict[tuple[int, int], list[int]] = field(default_factory=lambda: defaultdict(list))

    def vertex(self, p: Point) -> int:
        """The first vertex within the weld of p, else a new one."""
        i, j = (math.floor(v / (self.weld + ROUNDING)) for v in p)
        around = [k for a in (i - 1, i, i + 1) for b in (j - 1, j, j + 1) for k in self.cells.get((a, b), ())]
        known = min((k for k in around if math.dist(self.vertices[k], p) <= self.weld + ROUNDING), default=None)
        if known is None:
            known = len(self.vertices)
            self.vertices.append(p)
            self.near.append(set())
            self.cells[i, j].append(known)
        return known

    def join(self, a: int, b: int) -> None:
        if a != b:
            self.near[a].add(b)
            self.near[b].add(a)

    def add(self, p: Point, q: Point) -> None:
        a, b = self.vertex(p), self.vertex(q)
        self.join(a, b)
        if a != b:
            for k, n, end in ((a, b, p), (b, a, q)):
                if math.dist(self.vertices[k], end) > ROUNDING:
                    self.own.setdefault((k, n), end)

    def points(self, ring: list[int]) -> Ring:
        """The places of a ring of vertices: where two segments end apart within the weld, both places."""
        out = []
        for before, at, after in zip(ring[-1:] + ring[:-1], ring, ring[1:] + ring[:1]):
            ends = [self.own.get((at, n), self.vertices[at]) for n in (before, after)]
            out += ends if math.dist(*ends) > ROUNDING else ends[:1]
        return out

    def ends(self) -> list[int]:
        return [k for k, n in enumerate(self.near) if len(n) == 1]

    def outward(self, ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(places of the ends, directions in which they would go on)."""
        at = np.array([self.vertices[k] for k in ends]).reshape(-1, 2)
        back = np.array([self.vertices[next(iter(self.near[k]))] for k in ends]).reshape(-1, 2)
        return at, (at - back) / np.linalg.norm(at - back, axis=1, keepdims=True)

    def run_length(self, end: int) -> float:
        """How far the section goes straight back from an end, within the weld."""
        before, at = end, next(iter(self.near[end]))
        origin = np.array(self.vertices[end])
        way = np.array(self.vertices[at]) - origin
        length = float(np.linalg.norm(way))
        way /= length
        while len(self.near[at]) == 2:
            before, at = at, next(k for k in self.near[at] if k != before)
            delta = np.array(self.vertices[at]) - origin
            along = float(delta @ way)
            if at == end or abs(_cross(way, delta)) > self.weld or along < length - self.weld:
                break
            length = max(length, along)
        return length


def _cross(a, b):
    return a[..., 0] * b[..., 1] - a[..., 1] * b[..., 0]


def _mutual(choice: dict[int, int]) -> list[tuple[int, int]]:
    return [(a, b) for a, b in choice.items() if a < b and choice.get(b) == a]


def close_seams(s: Section, seam: float) -> int:
    """Joins ends that point at each other, are each other's nearest such, and lie on one line within the weld."""
    ends = s.ends()
    at, out = s.outward(ends)
    choice = {}
    for k, end in enumerate(ends):
        delta = at - at[k]
        gap = np.linalg.norm(delta, axis=1)
        way = delta / np.maximum(gap, 1e-12)[:, None]
        good = (gap > 1e-6) & (gap <= seam + ROUNDING) & (out @ out[k] < OPPOSED) & (way @ out[k] > TOWARDS) & (-(way * out).sum(axis=1) > TOWARDS)
        good &= (np.abs(_cross(out[k], delta)) <= s.weld) & (np.abs(_cross(out, delta)) <= s.weld)
        good &= np.array([e not in s.near[end] for e in ends], bool)
        if good.any():
            choice[end] = ends[int(np.where(good, gap, np.inf).argmin())]
    pairs = _mutual(choice)
    for a, b in pairs:
        s.join(a, b)
    return len(pairs)


def close_corners(s: Section, gap: float, reach: float) -> int:
    """Lengthens ends that are each other's nearest to where their directions meet, if that is near in length and in share of the straight run, and crosses nothing."""
    if gap <= 0 or reach <= 0:
        return 0
    ends = s.ends()
    at, out = s.outward(ends)
    choice, corner = {}, {}
    for k, end in enumerate(ends):
        far = np.linalg.norm(at - at[k], axis=1)
        far[[e == end or e in s.near[end] for e in ends]] = np.inf
        j = int(far.argmin())
        sine = float(_cross(out[k], out[j]))
        if far[j] >= gap - ROUNDING or abs(sine) < BENT:
            continue
        longer = (float(_cross(at[j] - at[k], out[j])) / sine, float(_cross(at[j] - at[k], out[k])) / sine)
        most = [min(reach, max(min(AT_LEAST, reach), OF_RUN * s.run_length(e))) for e in (end, ends[j])]
        if all(-BACK * s.weld - ROUNDING <= x <= m + ROUNDING for x, m in zip(longer, most)):
            choice[end], corner[end] = ends[j], at[k] + longer[0] * out[k]
    made = 0
    for a, b in _mutual(choice):
        point = (corner[a] + corner[b]) / 2
        if len(s.near[a]) == len(s.near[b]) == 1 and not any(_crosses(s, np.array(s.vertices[e]), point) for e in (a, b)):
            c = s.vertex((float(point[0]), float(point[1])))
            s.join(a, c)
            s.join(c, b)
            made += 1
    return made


def _crosses(s: Section, p: np.ndarray, q: np.ndarray) -> bool:
    """Whether the segment passes from one side of an edge to the other, and the edge from one side of it to the other."""
    pairs = [(k, n) for k, near in enumerate(s.near) for n in near if k < n]
    v = np.array(s.vertices)
    u, w = v[[k for k, _ in pairs]], v[[n for _, n in pairs]]
    own = _cross(q - p, u - p) * _cross(q - p, w - p)
    other = _cross(w - u, p - u) * _cross(w - u, q - u)
    return bool(((own < -1e-8) & (other < -1e-8)).any())


def loops_of(s: Section, each: bool) -> tuple[list[Ring], int, bool]:
    """(loops, the largest first; parts that are none; whether a vertex has other than two neighbours)."""
    loops, odd, seen = [], 0, set()
    for first, near in enumerate(s.near):
        if first in seen or not near:
            continue
        part, todo = {first}, [first]
        while todo:
            for k in s.near[todo.pop()] - part:
                part.add(k)
                todo.append(k)
        seen |= part
        ring: list[int] = []
        if all(len(s.near[k]) == 2 for k in part):
            before, at = None, first
            while not ring or at != first:
                ring.append(at)
                before, at = at, min(k for k in s.near[at] if k != before)
        points = s.points(ring)
        if len(ring) > 2 and abs(signed_area(points)) > LEAST_AREA:
            loops.append(points)
        else:
            odd += 1
    loops.sort(key=lambda r: -abs(signed_area(r)))
    return loops, odd, any(len(n) not in (0, 2) for n in s.near)


def section_loops(segments: list[tuple[Point, Point]], p: OutlineParams) -> dict:
    """loops (rings, the largest first), reason where there are none, and figures: vertices, branches, open (loose ends before), seams, corners, invalid."""
    s = Section(p.weld)
    for a, b in segments:
        s.add(a, b)
    branches, open_ = sum(len(n) > 2 for n in s.near), len(s.ends())
    found = {"loops": [], "reason": None, "vertices": len(s.vertices), "branches": branches, "open": open_, "seams": 0, "corners": 0, "invalid": 0}
    if len(s.vertices) < 3:
        return found | {"reason": "no cross-section"}
    if branches and not p.each:
        return found | {"reason": "branched cross-section"}
    found["seams"] = close_seams(s, p.seam)
    found["corners"] = close_corners(s, p.corner_gap, p.corner_reach)
    loops, odd, bad = loops_of(s, p.each)
    found["invalid"] = odd if p.each else 0
    if bad and not p.each:
        return found | {"reason": "open cross-section"}
    if not loops:
        return found | {"reason": "no independently enclosed cross-section" if p.each else "no enclosed cross-section"}
    return found | {"loops": loops}


#: Fixed values of boxes from facades: least length of a segment that tells a direction, directions tried, how far from a side a segment may lie
#: against the lesser width, what may lie inside against the border, and how much of each side must be covered.
TELLING, TRIED, SIDE, INSIDE, COVERED = 1.0, 12, 0.025, 0.045, 0.97


def facade_box(a: np.ndarray, b: np.ndarray, tolerance: float) -> Ring | None:
    """The smallest box about segments (n by 2 each) along one of their own directions, if segments cover its four sides and hardly any lie elsewhere."""
    delta = b - a
    length = np.hypot(*delta.T)
    telling = np.flatnonzero(length > TELLING)
    if not len(telling):
        return None
    # directions in steps of a quarter degree, those with the most length first
    key = np.rint(np.arctan2(delta[telling, 1], delta[telling, 0]) % (np.pi / 2) * 720 / np.pi).astype(int)
    kinds, first, place = np.unique(key, return_index=True, return_inverse=True)
    weight = np.bincount(place, length[telling])
    best = None
    for k in np.lexsort((kinds, -weight))[:TRIED]:
        u = delta[telling[first[k]]] / length[telling[first[k]]]
        frame = np.column_stack([u, (-u[1], u[0])])
        p, q = a @ frame, b @ frame
        low, high = np.minimum(p, q).min(axis=0), np.maximum(p, q).max(axis=0)
        if best is None or np.prod(high - low) < best[0]:
            best = (np.prod(high - low), frame, p, q, low, high)
    _, frame, p, q, low, high = best
    size = high - low
    if size.min() < 1 or not sides_covered(p, q, low, high, min(tolerance, SIDE * size.min()), INSIDE):
        return None
    return [tuple(frame @ c) for c in ((low[0], low[1]), (high[0], low[1]), (high[0], high[1]), (low[0], high[1]))]


def sides_covered(p: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray, near: float, inside: float) -> bool:
    """Whether segments (in the frame of a box) cover each of its sides, and what lies on none is short against its border."""
    size = high - low
    on = np.column_stack([(np.abs(p[:, v] - end[v]) <= near) & (np.abs(q[:, v] - end[v]) <= near) for v in (0, 1) for end in (low, high)])
    side = np.where(on.any(axis=1), on.argmax(axis=1), -1)
    if np.hypot(*(p - q)[side < 0].T).sum() > 2 * size.sum() * inside:
        return False
    for k in range(4):
        along = 1 - k // 2
        own = side == k
        start, end = np.minimum(p, q)[own, along], np.maximum(p, q)[own, along]
        order = np.argsort(start, kind="stable")
        reach = np.maximum.accumulate(np.r_[-np.inf, end[order]])[:-1]
        if np.maximum(0, end[order] - np.maximum(start[order], reach)).sum() < COVERED * size[along]:
            return False
    return True


#: Fixed values of facades about a hull: its share of the box, how far from a side a segment may lie, in all and against the lesser width, what may lie inside.
HULL, HULL_NEAR, HULL_SIDE, HULL_INSIDE = 0.97, 1.0, 0.02, 0.07


def facade_hull(a: np.ndarray, b: np.ndarray) -> Ring | None:
    """The convex hull of segments if it nearly is the smallest box about it, whose four sides they cover."""
    try:
        ring = hull([tuple(p) for p in np.concatenate([a, b]).tolist()])
        corners, width, depth, angle = smallest_box(ring)
    except ValueError:
        return None
    if width * depth < 1 or abs(signed_area(ring)) < HULL * width * depth:
        return None
    turn = np.array([[math.cos(angle), -math.sin(angle)], [math.sin(angle), math.cos(angle)]])
    p, q, box = a @ turn, b @ turn, np.array(corners) @ turn
    near = min(HULL_NEAR, HULL_SIDE * min(width, depth))
    return ring if sides_covered(p, q, box.min(axis=0), box.max(axis=0), near, HULL_INSIDE) else None

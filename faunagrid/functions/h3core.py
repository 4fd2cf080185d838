"""The public H3 grid: places to cells, cells to centres and boundaries, and all cells of a resolution.

A cell is a point of a hexagonal lattice on a face of an icosahedron, in gnomonic projection. Its id
names one of 122 base cells and, for each finer resolution, a step to one of seven children. Here
the neighbouring faces are found, and laid out next to a face, from the shared corners of their
triangles, and base cells seen from another face than their own from the same layouts.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the public H3 specification: centre of each face (latitude and longitude in radians)
# and the azimuth of its first axis there.
FACES = np.array(
    [
        (0.803582649718989942, 1.248397419617396099, 5.619958268523939882),
        (1.307747883455638156, 2.536945009877921159, 5.760339081714187279),
        (1.054751253523952054, -1.347517358900396623, 0.780213654393430055),
        (0.600191595538186799, -0.450603909469755746, 0.430469363979999913),
        (0.491715428198773866, 0.401988202911306943, 6.130269123335111400),
        (0.172745327415618701, 1.678146885280433686, 2.692877706530642877),
        (0.605929321571350690, 2.953923329812411617, 2.982963003477243874),
        (0.427370518328979641, -1.888876200336285401, 3.532912002790141181),
        (-0.079066118549212831, -0.733429513380867741, 3.494305004259568154),
        (-0.230961644455383637, 0.506495587332349035, 3.003214169499538391),
        (0.079066118549212831, 2.408163140208925497, 5.930472956509811562),
        (0.230961644455383637, -2.635097066257444203, 0.138378484090254847),
        (-0.172745327415618701, -1.463445768309359553, 0.448714947059150361),
        (-0.605929321571350690, -0.187669323777381622, 0.158629650112549365),
        (-0.427370518328979641, 1.252716453253507838, 5.891865957979238535),
        (-0.600191595538186799, 2.690988744120037492, 2.711123289609793325),
        (-0.491715428198773866, -2.739604450678486295, 3.294508837434268316),
        (-0.803582649718989942, -1.893195233972397139, 3.804819692245439833),
        (-1.307747883455638156, -0.604647643711872080, 3.664438879055192436),
        (-1.054751253523952054, 1.794075294689396615, 2.361378999196363184),
    ]
)
# Fixed values of the specification: face and i, j, k of every base cell, in their order; 200 is a corner of a face.
BASE_CELLS = """
1:100 2:110 1:000 2:100 0:200 1:110 1:001 2:000 0:100 2:010 1:010 1:011 3:100 3:110 11:200 4:100 0:000 6:010 0:001 2:011
7:001 2:001 0:110 6:001 10:200 6:000 3:000 11:100 4:110 3:010 0:011 4:000 5:010 0:010 7:010 11:110 7:000 10:100 12:200 6:101
7:101 4:001 3:001 3:011 4:010 6:100 11:000 8:001 5:001 14:200 5:000 12:100 10:110 4:011 12:110 7:100 11:010 10:000 13:200 10:001
11:001 9:010 8:010 6:200 8:000 9:001 14:100 5:101 16:011 8:101 5:100 12:000 7:200 12:010 10:010 9:000 13:100 16:001 15:011 15:010
16:010 14:110 13:110 5:200 8:100 14:000 9:101 14:001 17:001 12:001 16:000 17:011 15:001 16:101 9:100 15:000 13:000 8:200 13:010 17:101
19:010 14:010 19:011 17:010 13:001 17:000 16:100 9:200 15:101 15:100 18:011 18:001 19:001 17:100 19:000 18:010 18:101 19:200 19:100 18:000
19:101 18:100
"""
MAX_RES = 15
_UNIT = 0.38196601125010500003  # gnomonic length of the lattice's unit at resolution 0
_ROT7 = 0.333473172251832115336  # turn of the odd resolutions
_SIN60 = np.sqrt(3) / 2
#: Steps by digit, as i - k and j - k; digits in counter-clockwise order, from 0 degrees on.
_STEPS = np.array([(0, 0), (-1, -1), (0, 1), (-1, 0), (1, 0), (0, -1), (1, 1)])
_TURN = [4, 6, 2, 3, 1, 5]
_CORNERS = np.array([(2.0, 0.0), (-1.0, 2 * _SIN60), (-1.0, -2 * _SIN60)])
_NORMALS = np.array([(0.5, _SIN60), (-1.0, 0.0), (0.5, -_SIN60)])  # of edges 0-1, 1-2, 2-0, at distance 1


def _turned(v: np.ndarray, angle) -> np.ndarray:
    c, s = np.cos(angle), np.sin(angle)
    return np.stack([c * v[..., 0] - s * v[..., 1], s * v[..., 0] + c * v[..., 1]], -1)


def _xyz(lat: np.ndarray, lng: np.ndarray) -> np.ndarray:
    return np.stack([np.cos(lat) * np.cos(lng), np.cos(lat) * np.sin(lng), np.sin(lat)], -1)


_CENTRES = _xyz(FACES[:, 0], FACES[:, 1])
_NORTH = np.stack([-np.sin(FACES[:, 0]) * np.cos(FACES[:, 1]), -np.sin(FACES[:, 0]) * np.sin(FACES[:, 1]), np.cos(FACES[:, 0])], -1)
_EAST = np.stack([-np.sin(FACES[:, 1]), np.cos(FACES[:, 1]), np.zeros(20)], -1)
#: The plane of each face: its first axis, and the one a quarter turn counter-clockwise.
_X = np.cos(FACES[:, 2:]) * _NORTH + np.sin(FACES[:, 2:]) * _EAST
_Y = np.sin(FACES[:, 2:]) * _NORTH - np.cos(FACES[:, 2:]) * _EAST


def _to_plane(face: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Unit vectors to the planes of their faces, in units of resolution 0."""
    depth = (p * _CENTRES[face]).sum(-1)
    return np.stack([(p * _X[face]).sum(-1), (p * _Y[face]).sum(-1)], -1) / depth[..., None] / _UNIT


def _from_plane(face: np.ndarray, v: np.ndarray) -> np.ndarray:
    p = _CENTRES[face] + _UNIT * (v[..., :1] * _X[face] + v[..., 1:] * _Y[face])
    return p / np.linalg.norm(p, axis=-1, keepdims=True)


class _Layout:
    """For each face and edge: the neighbour, and the motion (angle, shift) of this plane to the neighbour's."""

    def __init__(self) -> None:
        faces = np.arange(20)
        corners = np.stack([_from_plane(faces, np.broadcast_to(c, (20, 2))) for c in _CORNERS], 1)
        self.neighbour = np.zeros((20, 3), int)
        self.angle = np.zeros((20, 3))
        self.shift = np.zeros((20, 3, 2))
        for f in range(20):
            for e in range(3):
                a, b = corners[f, e], corners[f, (e + 1) % 3]
                for g in range(20):
                    if g == f:
                        continue
                    at = [int(np.argmax(corners[g] @ p)) for p in (a, b)]
                    if all(corners[g, i] @ p > 1 - 1e-9 for i, p in zip(at, (a, b), strict=True)):
                        here, there = _CORNERS[(e + 1) % 3] - _CORNERS[e], _CORNERS[at[1]] - _CORNERS[at[0]]
                        turn = np.arctan2(there[1], there[0]) - np.arctan2(here[1], here[0])
                        turn = np.round(turn / (np.pi / 3)) * (np.pi / 3)
                        self.neighbour[f, e], self.angle[f, e] = g, turn
                        self.shift[f, e] = _CORNERS[at[0]] - _turned(_CORNERS[e], turn)

    def cross(self, face: np.ndarray, v: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.neighbour[face, edge], _turned(v, self.angle[face, edge]) + self.shift[face, edge]

    def settle(self, face: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Points outside their face's triangle, laid out on the face on which they are."""
        face, v = face.copy(), v.copy()
        for _ in range(3):
            over = v @ _NORMALS.T
            edge = over.argmax(1)
            out = over.max(1) > 1 + 1e-9
            if not out.any():
                break
            face[out], v[out] = self.cross(face[out], v[out], edge[out])
        return face, v


def _lattice(v: np.ndarray) -> np.ndarray:
    """The nearest lattice point (i - k, j - k)."""
    b = v[:, 1] / _SIN60
    a = v[:, 0] + b / 2
    c = b - a  # a, -b and c sum to 0
    x, y, z = np.round(a), np.round(-b), np.round(c)
    dx, dy, dz = np.abs(x - a), np.abs(y + b), np.abs(z - c)
    first = (dx > dy) & (dx > dz)
    second = ~first & (dy > dz)
    x = np.where(first, -y - z, x)
    y = np.where(second, -x - z, y)
    return np.stack([x, -y], 1).astype(np.int64)


def _point(a: np.ndarray) -> np.ndarray:
    return np.stack([a[..., 0] - a[..., 1] / 2, a[..., 1] * _SIN60], -1)


def _up(a: np.ndarray, res: int) -> np.ndarray:
    i, j = a[:, 0], a[:, 1]
    p, q = (3 * i - j, i + 2 * j) if res % 2 else (2 * i + j, 3 * j - i)
    return np.stack([(2 * p + 7) // 14, (2 * q + 7) // 14], 1)  # nearest; a seventh is never a half


def _down(a: np.ndarray, res: int) -> np.ndarray:
    i, j = a[:, 0], a[:, 1]
    return np.stack([2 * i + j, 3 * j - i] if res % 2 else [3 * i - j, i + 2 * j], 1)


class _Tables:
    """Everything that follows from the fixed values."""

    def __init__(self) -> None:
        self.layout = _Layout()
        cells = [x.split(":") for x in BASE_CELLS.split()]
        self.home = np.array([int(f) for f, _ in cells])
        ijk = np.array([[int(c) for c in x] for _, x in cells])
        self.start = ijk[:, :2] - ijk[:, 2:]
        self.pentagon = (ijk == (2, 0, 0)).all(1)
        centres = _from_plane(self.home, _point(self.start))
        #: By face, i - k + 2 and j - k + 2 of the lattice at resolution 0: base cell and turns to its own face.
        self.base = np.full((20, 5, 5), -1)
        self.turns = np.zeros((20, 5, 5), int)
        self.around = np.zeros((20, 5, 5), int)  # of corners: steps counter-clockwise from the home face
        for f in range(20):
            for a in range(-2, 3):
                for b in range(-2, 3):
                    v = _point(np.array([[a, b]]))
                    g, w = self.layout.settle(np.array([f]), v)
                    near = centres @ _from_plane(g, w)[0]
                    own = int(near.argmax())
                    if near[own] < 1 - 1e-6:
                        continue
                    at = f, a + 2, b + 2
                    self.base[at] = own
                    if self.pentagon[own]:
                        corner = int(np.argmin(np.abs(_CORNERS - v).sum(1)))
                        if np.abs(_CORNERS[corner] - v).sum() > 1e-6:
                            self.base[at] = -1
                            continue
                        steps = self.steps(int(self.home[own]), f)
                        self.around[at] = steps
                        sector = (180 + 120 * corner) % 360  # where the face lies from that corner
                        self.turns[at] = (((180, 300, 0, 60, 120)[steps] - sector) // 60) % 6
                    elif f != self.home[own]:
                        self.turns[at] = self.turn_of(f, v, own)

    def steps(self, home: int, face: int) -> int:
        """Faces around the first corner of ``home``, counter-clockwise, up to ``face``."""
        g, corner = home, 0
        for n in range(5):
            if g == face:
                return n
            edge = corner  # from a corner, its own edge is the counter-clockwise end of the face as seen from it
            v = _CORNERS[corner][None]
            nxt, w = self.layout.cross(np.array([g]), v, np.array([(edge + 2) % 3]))
            g, corner = int(nxt[0]), int(np.abs(_CORNERS - w).sum(1).argmin())
        raise ValueError(f"face {face} does not touch the corner")

    def turn_of(self, f: int, v: np.ndarray, own: int) -> int:
        target = _point(self.start[own][None])
        for e in range(3):
            g, w = self.layout.cross(np.array([f]), v, np.array([e]))
            if g[0] == self.home[own] and np.abs(w - target).max() < 1e-6:
                return int(np.round(self.layout.angle[f, e] / (np.pi / 3))) % 6
        for e in range(3):  # by two edges
            g, w = self.layout.cross(np.array([f]), v, np.array([e]))
            for d in range(3):
                h, u = self.layout.cross(g, w, np.array([d]))
                if h[0] == self.home[own] and np.abs(u - target).max() < 1e-6:
                    return int(np.round((self.layout.angle[f, e] + self.layout.angle[int(g[0]), d]) / (np.pi / 3))) % 6
        return 0


@lru_cache(maxsize=1)
def tables() -> _Tables:
    return _Tables()


_TURNED = np.zeros((6, 7), np.int64)  # by turns of 60 degrees counter-clockwise: what becomes of each digit
for _k in range(6):
    for _n, _digit in enumerate(_TURN):
        _TURNED[_k, _digit] = _TURN[(_n + _k) % 6]


def encode(lat: np.ndarray, lng: np.ndarray, res: int) -> np.ndarray:
    """Cells of places in degrees."""
    t = tables()
    p = _xyz(np.radians(np.asarray(lat, float)), np.radians(np.asarray(lng, float)))
    face = (p @ _CENTRES.T).argmax(1)
    v = _to_plane(face, p) * np.sqrt(7.0) ** res
    a = _lattice(_turned(v, -_ROT7) if res % 2 else v)
    digits = np.zeros((len(p), res), np.int64)
    for r in range(res, 0, -1):
        above = _up(a, r)
        step = a - _down(above, r)
        digits[:, r - 1] = _digit_of(step)
        a = above
    at = face, a[:, 0] + 2, a[:, 1] + 2
    base, turns, around = t.base[at], t.turns[at], t.around[at]
    digits = _TURNED[turns[:, None], digits]
    lead = _leading(digits)
    # on pentagons the first digit is left out: from the home face its places belong to the next one, from there to the home face
    deleted = t.pentagon[base] & (lead == 1)
    turn = np.where(deleted, np.where(around == 0, 1, 5), 0)
    digits = _TURNED[turn[:, None], digits]
    return packed(base, digits, res)


def _digit_of(step: np.ndarray) -> np.ndarray:
    code = np.full((3, 3), -1)
    for d, (i, j) in enumerate(_STEPS):
        code[i + 1, j + 1] = d
    return code[step[:, 0] + 1, step[:, 1] + 1]


def _leading(digits: np.ndarray) -> np.ndarray:
    """The first digit that is not 0, or 0."""
    if not digits.shape[1]:
        return np.zeros(len(digits), np.int64)
    first = (digits != 0).argmax(1)
    return digits[np.arange(len(digits)), first]


def packed(base: np.ndarray, digits: np.ndarray, res: int) -> np.ndarray:
    out = np.full(len(base), 1 << 59 | res << 52, np.int64) | base.astype(np.int64) << 45
    for r in range(1, MAX_RES + 1):
        out |= (digits[:, r - 1] if r <= res else np.int64(7)) << 3 * (MAX_RES - r)
    return out


def _unpacked(cells: np.ndarray, res: int) -> tuple[np.ndarray, np.ndarray]:
    digits = np.stack([cells >> 3 * (MAX_RES - r) & 7 for r in range(1, res + 1)], 1) if res else np.zeros((len(cells), 0), np.int64)
    return (cells >> 45 & 127).astype(int), digits


def _settled(cells: np.ndarray, res: int, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Faces (n, m), and places (n, m, 2) on them, of points of cells of one resolution: lattice offsets (n, m, 2) from each centre, in the cell's plane."""
    t = tables()
    base, digits = _unpacked(cells, res)
    lead = _leading(digits)
    pentagon = t.pentagon[base]
    a = t.start[base]
    for r in range(1, res + 1):
        a = _down(a, r) + _STEPS[digits[:, r - 1]]
    v = (_point(a)[:, None, :] + offsets) / np.sqrt(7.0) ** res
    v = _turned(v, _ROT7) if res % 2 else v
    m = v.shape[1]
    face = np.repeat(t.home[base], m)
    v, lead, pentagon = v.reshape(-1, 2), np.repeat(lead, m), np.repeat(pentagon, m)
    plain = ~pentagon
    out_face, out_v = face.copy(), v.copy()
    out_face[plain], out_v[plain] = t.layout.settle(face[plain], v[plain])
    if pentagon.any():
        rows = np.flatnonzero(pentagon)
        corner = _CORNERS[0]
        w = v[rows] - corner
        back = np.isin(lead[rows], (5, 4))
        w = np.where(back[:, None], _turned(w, -np.pi / 3), w)
        angle = np.degrees(np.arctan2(w[:, 1], w[:, 0])) % 360
        # sectors of 60 degrees around the home face's own, laid out on one side or on the other
        angle = np.where(back, angle + 360 * (angle < 120), angle)
        angle = np.where(~back & (angle > 300), angle - 360, angle)
        steps = np.floor((angle - 150 + 1e-9) / 60).astype(int)
        steps[np.hypot(w[:, 0], w[:, 1]) < 1e-12] = 0
        f, u = face[rows].copy(), w + corner
        for n in range(1, 5):
            for side, edge_of in ((1, 2), (-1, 0)):
                at = np.flatnonzero(steps * side >= n)
                if len(at):
                    own = _corner_index(u[at], w[at])
                    f[at], u[at], w[at] = _around(t.layout, f[at], u[at], w[at], (own + edge_of) % 3)
        out_face[rows], out_v[rows] = f, u
    return out_face.reshape(len(cells), m), out_v.reshape(len(cells), m, 2)


def _places(cells: np.ndarray, res: int, offsets: np.ndarray) -> np.ndarray:
    """Unit vectors of points of cells."""
    return _from_plane(*_settled(cells, res, offsets))


def _bends(face: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the sides of n outlines from each corner to the next: whether one bends at an edge of the icosahedron, and there the unit vector."""
    layout = tables().layout
    f, g = face.reshape(-1), np.roll(face, -1, axis=1).reshape(-1)
    here, there = v.reshape(-1, 2), np.roll(v, -1, axis=1).reshape(-1, 2)
    bent, at = np.zeros(len(f), bool), np.zeros((len(f), 3))
    for edge in range(3):  # of the second corner's face, behind which the first one's is
        rows = np.flatnonzero((f != g) & (layout.neighbour[g, edge] == f))
        if not len(rows):
            continue
        end = layout.cross(g[rows], there[rows], np.full(len(rows), edge))[1]
        own = (layout.neighbour[f[rows]] == g[rows, None]).argmax(1)  # the same edge, of the first corner's face
        low, high = (here[rows] * _NORMALS[own]).sum(1), (end * _NORMALS[own]).sum(1)
        t = (1 - low) / np.where(high > low, high - low, np.inf)
        good = (t > 1e-6) & (t < 1 - 1e-6)
        point = here[rows] + t[:, None] * (end - here[rows])
        bent[rows], at[rows] = good, _from_plane(f[rows], point)
    return bent.reshape(face.shape), at.reshape(*face.shape, 3)


def _corner_index(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.abs(_CORNERS[None] - (u - w)[:, None, :]).sum(2).argmin(1)


def _around(layout: _Layout, f: np.ndarray, u: np.ndarray, w: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    turned = _turned(w, layout.angle[f, edge])
    g, moved = layout.cross(f, u, edge)
    return g, moved, turned


def decode(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Latitude and longitude of centres, in degrees."""
    cells = np.asarray(cells, np.int64)
    lat, lng = np.zeros(len(cells)), np.zeros(len(cells))
    of = cells >> 52 & 15
    for res in np.unique(of):
        at = np.flatnonzero(of == res)
        p = _places(cells[at], int(res), np.zeros((len(at), 1, 2)))[:, 0]
        lat[at], lng[at] = np.degrees(np.arcsin(np.clip(p[:, 2], -1, 1))), np.degrees(np.arctan2(p[:, 1], p[:, 0]))
    return lat, lng


def valid(cells: np.ndarray) -> np.ndarray:
    """Whether ids name cells."""
    cells = np.asarray(cells, np.int64)
    base, res = cells >> 45 & 127, cells >> 52 & 15
    ok = (cells >> 56 == 8) & (base < 122)
    lead = np.zeros(len(cells), np.int64)
    for r in range(1, MAX_RES + 1):
        digit = cells >> 3 * (MAX_RES - r) & 7
        ok &= np.where(r <= res, digit < 7, digit == 7)
        lead = np.where((lead == 0) & (r <= res), digit, lead)
    return ok & ~(tables().pentagon[np.minimum(base, 121).astype(int)] & (lead == 1))


def boundary(cells: np.ndarray) -> list[np.ndarray]:
    """Corners (lng, lat) of each cell in counter-clockwise order: six, or five of pentagons, and one more where a side crosses an edge of the icosahedron."""
    cells = np.asarray(cells, np.int64)
    out: list[np.ndarray] = [np.empty((0, 2))] * len(cells)
    of = cells >> 52 & 15
    for res in np.unique(of):
        at = np.flatnonzero(of == res)
        base, digits = _unpacked(cells[at], int(res))
        five = tables().pentagon[base] & (_leading(digits) == 0)
        for corners, rows in ((6, at[~five]), (5, at[five])):
            if len(rows):
                # a pentagon lacks the sector at 240 degrees: its corners are those of the others
                turns = np.radians(np.array([270, 330, 30, 90, 150, 210]) if corners == 6 else np.array([330, 30, 90, 150, 210]))
                offsets = np.stack([np.cos(turns), np.sin(turns)], 1) / np.sqrt(3)
                face, v = _settled(cells[rows], int(res), np.broadcast_to(offsets, (len(rows), corners, 2)))
                bent, more = _bends(face, v)
                p = np.stack([_from_plane(face, v), more], 2).reshape(len(rows), 2 * corners, 3)
                kept = np.stack([np.ones_like(bent), bent], 2).reshape(len(rows), 2 * corners)
                for k, row in enumerate(rows):
                    ring = p[k, kept[k]]
                    out[row] = np.degrees(np.stack([np.arctan2(ring[:, 1], ring[:, 0]), np.arcsin(np.clip(ring[:, 2], -1, 1))], 1))
    return out


# --- in Spark ---


def latlng_to_cell(lat: Column, lng: Column, res: int | Column) -> Column:
    """Cell ids of places in degrees; NULL for missing, infinite or impossible ones."""

    @F.pandas_udf(T.LongType())
    def cells(lat: pd.Series, lng: pd.Series, res: pd.Series) -> pd.Series:
        a, b, r = lat.to_numpy(float), lng.to_numpy(float), res.to_numpy(float)
        out = pd.Series(pd.array([None] * len(a), dtype="Int64"))
        good = np.isfinite(a) & np.isfinite(b) & (np.abs(a) <= 90) & (np.abs(b) <= 360) & (r >= 0) & (r <= MAX_RES)
        for own in np.unique(r[good]):
            at = np.flatnonzero(good & (r == own))
            out.iloc[at] = encode(a[at], b[at], int(own))
        return out

    return cells(lat.cast("double"), lng.cast("double"), F.lit(res) if isinstance(res, int) else res)


def cell_to_latlng(cell: Column) -> Column:
    """(lat, lng) of a cell's centre, in degrees; NULL for what is no cell."""

    @F.pandas_udf("lat double, lng double")
    def centres(cells: pd.Series) -> pd.DataFrame:
        ids, missing = cells.fillna(0).astype("int64").to_numpy(), cells.isna().to_numpy()
        good = ~missing & valid(ids)
        out = np.zeros((len(ids), 2))
        if good.any():
            out[good] = np.stack(decode(ids[good]), 1)
        return pd.DataFrame({c: pd.arrays.FloatingArray(out[:, k].copy(), ~good) for k, c in enumerate(("lat", "lng"))})

    return centres(cell)


def _rings(corners: np.ndarray) -> list[np.ndarray]:
    """The polygon, or its two parts if it crosses the date line."""
    lng = corners[:, 0]
    if lng.max() - lng.min() <= 180:
        return [corners]
    wide = corners.copy()
    wide[:, 0] = np.where(lng < 0, lng + 360, lng)
    if wide[:, 0].max() - wide[:, 0].min() > 180:  # around a pole
        return [corners]
    parts = []
    for side in (1, -1):
        ring = []
        for a, b in zip(wide, np.roll(wide, -1, axis=0), strict=True):
            if (180 - a[0]) * side >= 0:
                ring.append(a)
            if (180 - a[0]) * (180 - b[0]) < 0:
                ring.append(a + (b - a) * (180 - a[0]) / (b[0] - a[0]))
        part = np.array(ring)
        if side < 0:
            part[:, 0] -= 360
        parts.append(part)
    return parts


def wkt(corners: np.ndarray) -> str:
    texts = ["((" + ", ".join(f"{x:.9f} {y:.9f}" for x, y in [*ring, ring[0]]) + "))" for ring in _rings(corners)]
    return f"POLYGON {texts[0]}" if len(texts) == 1 else f"MULTIPOLYGON ({', '.join(texts)})"


def cell_boundary_wkt(cell: Column) -> Column:
    """The cell's outline in WKT, in two parts where it crosses the date line; NULL for what is no cell."""

    @F.pandas_udf(T.StringType())
    def outlines(cells: pd.Series) -> pd.Series:
        ids, missing = cells.fillna(0).astype("int64").to_numpy(), cells.isna().to_numpy()
        good = np.flatnonzero(~missing & valid(ids))
        out = [None] * len(ids)
        for at, corners in zip(good, boundary(ids[good]), strict=True):
            out[at] = wkt(corners)
        return pd.Series(out, dtype=object)

    return outlines(cell)


def cell_corners(cell: Column) -> Column:
    """The corners of a cell, an array of (lng, lat) in degrees; NULL for what is no cell."""

    @F.pandas_udf("array<struct<lng: double, lat: double>>")
    def corners(cells: pd.Series) -> pd.Series:
        ids, missing = cells.fillna(0).astype("int64").to_numpy(), cells.isna().to_numpy()
        good = np.flatnonzero(~missing & valid(ids))
        out = [None] * len(ids)
        for at, ring in zip(good, boundary(ids[good]), strict=True):
            out[at] = [{"lng": x, "lat": y} for x, y in ring.tolist()]
        return pd.Series(out, dtype=object)

    return corners(cell)


def all_cells(spark: SparkSession, res: int) -> DataFrame:
    """(cell_id): the 2 + 120 * 7^res cells of a resolution, counted out by Spark."""
    if not 0 <= res <= MAX_RES:
        raise ValueError(f"no such resolution: {res}")
    pentagons = np.flatnonzero(tables().pentagon).tolist()
    rows = spark.range(122 * 7**res)
    base = F.expr(f"id div {7**res}")
    digits = [F.expr(f"(id div {7 ** (res - r)}) % 7") for r in range(1, res + 1)]
    lead = F.coalesce(*(F.when(d > 0, d) for d in digits), F.lit(0)) if digits else F.lit(0)
    cell = F.lit(1 << 59 | res << 52 | (1 << 3 * (MAX_RES - res)) - 1) + base * F.lit(1 << 45)
    for r, d in enumerate(digits, 1):
        cell = cell + d * F.lit(1 << 3 * (MAX_RES - r))
    return rows.where(~(base.isin(pentagons) & (lead == 1))).select(cell.cast("bigint").alias("cell_id"))

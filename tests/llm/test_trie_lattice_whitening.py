"""The prefix trie, lattice hashing and whitening against row-by-row versions."""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from barline.llm import lattice, trie, whitening
from barline.llm.common import table

# --- conversation prefix trie -----------------------------------------------------------

TURNS = "conv_id bigint, turn int, role string, text string, depth string, n string, ends int"


def slow_trie(rows):
    """All nodes from the definition; turns of one number by their digest."""

    def digest(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()

    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = (turn is not None, turn or 0, digest(role, text))
            own[conv].append((key, role, text))
    own = {c: [t[1:] for t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        value = (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        saved[path] = value + sum(saved[k] for k in kids[path])
    return sorted(
        (
            members[p][0],
            len(p),
            members[p[:-1]][0] if p else None,
            len(members[p]),
            len(kids[p]),
            leaves[p],
            saved[p],
            hashlib.sha256(
                ",".join(str(c) for c in members[p] if len(whole[c]) == len(p)).encode()
            ).hexdigest(),
        )
        for p in members
    )


def trie_rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def odd_turns():
    rows = [(c, i, "user", f"t{i}") for c in range(100, 130) for i in range(1 + c % 7)]
    rows += [(c, i, "user", "same 漢字 😀") for c in range(200, 260) for i in range(3)]
    rows += [(300, i, "a" if i % 2 else "u", f"long {i}") for i in range(700)]
    rows += [(301, i, "a" if i % 2 else "u", f"long {i}") for i in range(650)]
    rows += [(302, i, "a" if i % 2 else "u", f"long {i if i < 640 else -i}") for i in range(700)]
    rows += [
        (0, None, None, None),
        (0, None, None, "x"),
        (0, 1, "", ""),
        (0, 1, "", ""),  # a repeated row
        (0, 1, "b", "tie"),
        (1, 2, "user", None),
        (7, -5, None, "y" * 50_000),
        (-105, 0, "u", "minus"),
        (-100, 0, "u", "base of minus"),
        (2**62, 0, "u", "far"),
        (None, 0, "u", "no conversation"),
    ]
    return rows


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], TURNS).repartition(5)


@pytest.mark.parametrize(
    "how", [{}, {"span": 64, "shard": 3}, {"span": 7, "shard": 16, "turns": 40}], ids=str
)
def test_trie_of_odd_turns(spark, odd_turns, how):
    df = trie.prefix_trie(turns_frame(spark, odd_turns), **how)
    assert df.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]
    assert all(kind == "bigint" for _, kind in df.dtypes[:-1])
    assert trie_rows(df) == slow_trie(odd_turns)


def test_trie_of_the_smallest_table(spark, folder):
    conversations = table(spark, folder, "conversations")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in conversations.collect()]
    assert trie_rows(trie.prefix_trie(conversations, shard=4)) == slow_trie(rows)


def test_trie_of_no_turns(spark, odd_turns):
    assert trie.prefix_trie(turns_frame(spark, odd_turns).where("false")).collect() == []


def test_turnless_conversations_are_members_of_the_root(spark):
    """A conversation whose turns are all replaced by those of an absent first one."""
    conv = next(c for c in itertools.count(401) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(conv, 0, "u", "gone")]
    (root,) = trie.prefix_trie(turns_frame(spark, rows)).collect()
    assert (root.conv_id, root.depth, root.n_convs, root.n_leaves) == (conv, 0, 1, 1)
    assert root.ends_sha256 == hashlib.sha256(str(conv).encode()).hexdigest()


# --- embedding near-duplicates ------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, kept string, n_links string"


def slow_links(rows, threshold=0.98):
    """(vec_id, n_links, component_id) per row from all pairs."""

    def direction(v):
        if v is None or any(c is None or not math.isfinite(c) for c in v) or not any(v):
            return None
        # What the table holds: single precision.
        x = np.array(v, np.float32).astype(np.float64)
        x /= np.abs(x).max()
        return x / math.sqrt((x * x).sum())

    units = [direction(v) if label is not None else None for _, v, label in rows]
    links = defaultdict(set)
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = units[i], units[j]
        if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
            continue
        if float(a @ b) >= threshold:
            links[i].add(j)
            links[j].add(i)
    out = []
    for i, (vec, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((vec, len(links[i]), component, vec == component))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def near_vectors():
    rng = np.random.default_rng(3)
    rows, number = [], itertools.count(10)
    for label in (0, 1):
        for _ in range(12):
            centre = rng.standard_normal(64)
            for _ in range(int(rng.integers(1, 9))):
                noise = rng.standard_normal(64) * rng.uniform(0.02, 0.16)
                rows.append((next(number), (centre + noise).tolist(), label))
    hot = rng.standard_normal(64)
    rows += [(next(number), (hot + rng.standard_normal(64) * 0.08).tolist(), 2) for _ in range(90)]
    rows += [(next(number), hot.tolist(), 2) for _ in range(40)]
    rows += [(5, hot.tolist(), 2), (5, hot.tolist(), 2), (None, hot.tolist(), 3), (None, hot.tolist(), 3)]
    rows += [
        (1, None, 0),
        (2, [0.0] * 64, 0),
        (3, [0.0] * 64, 0),
        (4, [math.nan, *hot[1:].tolist()], 2),
        (6, [None, *hot[1:].tolist()], 2),
        (7, [math.inf, *hot[1:].tolist()], 2),
        (8, hot.tolist(), None),
        (9, hot.tolist(), None),
        (-3, (hot * 1e30).tolist(), 2),
        (-4, (hot * 1e-20).tolist(), 2),
        (-5, [], 2),
        (-6, [1.0, 2.0], 2),
        (-7, [2.0, 4.0], 2),
        (-8, [2.0], 2),
    ]
    return rows


def vectors_frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], VECTORS).repartition(4)


@pytest.mark.parametrize("block", [4, 256])
def test_links_of_odd_vectors(spark, near_vectors, block):
    df = lattice.near_duplicates(vectors_frame(spark, near_vectors), block=block)
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got == slow_links(near_vectors)


def test_no_vectors(spark, near_vectors):
    assert lattice.near_duplicates(vectors_frame(spark, near_vectors).where("false")).collect() == []


def test_recall_at_the_threshold():
    """Pairs that just meet the threshold share a cell in one of the tables."""
    rng = np.random.default_rng(11)
    a, b = rng.standard_normal((2, 4000, 64))
    a = lattice.unit_rows(a)
    b = lattice.unit_rows(b - (b * a).sum(1, keepdims=True) * a)
    other = lattice.THRESHOLD * a + math.sqrt(1 - lattice.THRESHOLD**2) * b
    x, y = (
        lattice.cell_codes(v).reshape(4000, lattice.TABLES, -1) for v in (a, lattice.unit_rows(other))
    )
    met = (x[:, :, :1] == y).any(axis=(1, 2)) | (y[:, :, :1] == x).any(axis=(1, 2))
    assert met.mean() > 0.99


def test_nearest_point_is_the_nearest_of_its_neighbours():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, 8)) * 3
    point = lattice.nearest_point(x)
    doubled = 2 * point
    assert np.array_equal(doubled, np.rint(doubled))
    assert (doubled % 2 == doubled[:, :1] % 2).all()
    assert (point.sum(axis=1) % 2 == 0).all()
    around = ((x[:, None] - point[:, None] - lattice.lattice_steps()[None]) ** 2).sum(-1).min(1)
    assert (((x - point) ** 2).sum(1) <= around + 1e-12).all()
    assert len(lattice.lattice_steps()) == 240


# --- whitening -----------------------------------------------------------------------------

EMBEDDED = "vec_id bigint, embedding array<double>, n string, component string"


def embedded(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], EMBEDDED).repartition(3)


def check_whitened(got, kept, top=32):
    """Against exact deviations and numpy's eigenvectors, up to sign."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept], object)
    n, sums = len(x), x.sum(axis=0)
    centred = np.array(x * n - sums, np.float64) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:top], axes[:, ::-1][:, :top]
    by_row = defaultdict(list)
    for r in got:
        by_row[r.vec_id].append(r)
    for i, (vec, _) in enumerate(kept):
        for r in by_row[vec]:
            assert r.n == n
            assert r.deviation == sum(int(e) ** 2 for e in x[i] * n - sums)
            assert abs(r.explained - values[r.component - 1] / np.trace(centred.T @ centred / n)) < 1e-9
            assert r.identity_error < 1e-9
    return centred, values, axes, by_row


def test_whitened_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((120, 40)) * np.linspace(0.1, 3, 40)
    kept = [(i, v.tolist()) for i, v in enumerate(base)] + [(7_000, base[0].tolist())]
    bad = [(-1, None), (-2, [None] * 40), (-3, [math.nan] * 40), (-4, [math.inf] * 40), (-5, []), (-6, [1.0])]
    got = whitening.whitened(embedded(spark, kept + bad)).collect()
    assert len(got) == len(kept) * 32
    centred, values, axes, by_row = check_whitened(got, kept)
    want = centred @ axes / np.sqrt(values)
    found = np.array([[r.whitened for r in sorted(by_row[i], key=lambda r: r.component)] for i, _ in kept])
    signs = np.sign((want * found).sum(axis=0))
    assert np.abs(found - want * signs).max() < 1e-8


def test_equal_variances_and_dimensions_without_any(spark):
    """A box: three equal eigenvalues, one smaller, two dimensions that never vary."""
    corners = list(itertools.product((-1.0, 1.0), repeat=4))
    kept = [(i, [a, b, c, d / 2, 5.0, -7.25]) for i, (a, b, c, d) in enumerate(corners)]
    got = whitening.whitened(embedded(spark, kept)).collect()
    assert len(got) == 16 * 4
    _, _, _, by_row = check_whitened(got, kept)
    w = np.array([[r.whitened for r in sorted(by_row[i], key=lambda r: r.component)] for i in range(16)])
    assert np.abs(w.T @ w / 16 - np.eye(4)).max() < 1e-12
    assert sorted({round(r.explained, 12) for r in got}) == [round(1 / 13, 12), round(4 / 13, 12)]


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(8)
    kept = [(i, (rng.standard_normal(3) * 1e6).tolist()) for i in range(9)]
    got = whitening.whitened(embedded(spark, kept)).collect()
    check_whitened(got, kept)
    huge = [(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [2.0**60, 0.0])]
    rows = whitening.whitened(embedded(spark, huge)).collect()
    assert {r.vec_id for r in rows} == {1, 2} and all(r.deviation is None for r in rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)]], ids=len)
def test_nothing_varies(spark, rows):
    df = whitening.whitened(embedded(spark, rows))
    assert df.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
    ]
    assert df.collect() == []


def test_null_ids_stay_apart_from_numbers(spark):
    rows = [(None, [0.0, 1.0]), (2**62 + 1, [1.0, 0.0]), (3, [2.0, 5.0])]
    got = whitening.whitened(embedded(spark, rows)).collect()
    assert {r.vec_id for r in got} == {None, 2**62 + 1, 3}


def test_characteristic_polynomial_against_exact_fractions(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(-50, 50, (5, 6)).astype(object)
    matrix = (a @ a.T).tolist()

    def determinant(m):
        m, sign, out = [[Fraction(x) for x in row] for row in m], 1, Fraction(1)
        for k in range(len(m)):
            pivot = next((i for i in range(k, len(m)) if m[i][k]), None)
            if pivot is None:
                return Fraction(0)
            if pivot != k:
                m[k], m[pivot], sign = m[pivot], m[k], -sign
            out *= m[k][k]
            for i in range(k + 1, len(m)):
                f = m[i][k] / m[k][k]
                m[i] = [x - f * y for x, y in zip(m[i], m[k], strict=True)]
        return sign * out

    poly = whitening.characteristic_polynomial(spark, matrix)
    for x in range(-3, 4):
        shifted = [[(x if i == j else 0) - v for j, v in enumerate(row)] for i, row in enumerate(matrix)]
        assert sum(c * x**i for i, c in enumerate(poly)) == determinant(shifted)


def test_roots_with_multiplicity():
    """(x - 2)^3 (x - 7) (x^2 - 10 x + 23): 7, 5 + sqrt 2, 5 - sqrt 2, 2, 2, 2."""
    poly = [1]
    for factor in ([-2, 1], [-2, 1], [-2, 1], [-7, 1], [23, -10, 1]):
        poly = [
            sum(poly[i] * factor[k - i] for i in range(len(poly)) if 0 <= k - i < len(factor))
            for k in range(len(poly) + len(factor) - 1)
        ]
    assert [whitening.roots_above(poly, a) for a in (0, 2, 3, 6, 7)] == [6, 3, 3, 2, 0]
    roots = [Fraction(a, 1 << b) for a, b in whitening.largest_roots(poly, 23, 6)]
    want = [7, 5 + math.sqrt(2), 5 - math.sqrt(2), 2, 2, 2]
    assert [float(r) for r in roots] == pytest.approx(want, abs=1e-14)
    assert roots[3:] == [2, 2, 2]

"""Every operator against a row-by-row version, on the odd texts and the smallest data."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tests.llm.conftest import table_rows

from barline.llm import classifier, exact, html, mixing, packing, pii, rules, sharding, simhash, warc
from barline.llm.common import table
from barline.llm.queries import ORACLE, QUERIES

WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def documents(spark, folder):
    return table(spark, folder, "documents")


def duck(folder, sql):
    con = duckdb.connect()
    for name in ("documents", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    found = con.execute(sql)
    names = [x[0] for x in found.description]
    return sorted(repr(tuple(r[names.index(c)] for c in sorted(names))) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_its_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert table_rows(df, sorted(df.columns)) == duck(folder, ORACLE[name])


# --- exact duplicates ---------------------------------------------------------------


@pytest.mark.parametrize("fan", [2, 8])
def test_exact_duplicates_of_odd_texts(odd, texts, fan):
    found = exact.exact_duplicates(odd, fan=fan).collect()
    assert len(found) == len(texts)
    groups = defaultdict(list)
    for i, t, _ in texts:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    for row in found:
        ids = groups[row.text_sha256]
        known = [i for i in ids if i is not None]
        assert row.group_size == len(ids)
        assert row.keep_id == (max(known) if known else None)
    assert Counter(r.text_sha256 for r in found if r.kept) == dict.fromkeys(groups, 1)


@pytest.mark.parametrize("fan", [2, 4])
def test_rounds_merge_sorted_runs(spark, documents, fan):
    """Every round leaves sorted cells with one entry a digest, and loses no row and no largest id."""
    copies = documents.where("doc_id % 3 = 0").selectExpr("doc_id + 1000000 AS doc_id", "text")
    docs = documents.select("doc_id", "text").union(copies).union(copies).repartition(11)
    digests = exact.digest_runs(docs, F.coalesce("text", F.lit("")))
    rows = digests.collect()
    runs = exact.sorted_runs(digests.withColumn("_rank", F.col("_id")), 8)
    last = max(r._run for r in rows)
    width = 1
    while True:
        slow = defaultdict(list)
        for r in rows:
            slow[r._run // width, bytes(r._sha)].append(r._id)
        found = {}
        for cell in runs.collect():
            shas = [bytes(e._sha) for e in cell._entries]
            assert shas == sorted(set(shas))
            assert {sha[0] >> 5 for sha in shas} == {cell._cell}
            for e in cell._entries:
                assert (cell._run, bytes(e._sha)) not in found
                found[cell._run, bytes(e._sha)] = (e._n, e._rank)
        assert found == {key: (len(ids), max(ids)) for key, ids in slow.items()}
        if last // width == 0:
            break
        runs, width = exact.merge_round(runs, fan), width * fan


def test_digests_that_differ_in_one_part_stay_apart(spark):
    """Entries collapse only if SHA-256, second hash and length all agree, also across runs."""
    key = (bytearray(32), 1, 5)
    rows = [(r, r, r, *key) for r in range(6)] + [(6, 6, 6, bytearray(32), 2, 5), (7, 7, 7, bytearray(32), 1, 6)]
    digests = spark.createDataFrame(
        rows, "_row bigint, _run int, _id bigint, _sha binary, _check bigint, _bytes int"
    )
    found = {r._row: (r._n, r._keep_id) for r in exact.merged_runs(digests, "smallest").collect()}
    assert found == {**dict.fromkeys(range(6), (6, 0)), 6: (1, 6), 7: (1, 7)}


def test_without_copies_keeps_one_row_and_all_columns(odd):
    left = exact.without_copies(odd)
    assert left.columns == odd.columns
    assert left.count() == odd.select("text").na.fill("").distinct().count()


# --- near duplicates ----------------------------------------------------------------


def slow_fingerprint(text):
    words = re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, distance=4):
    """Smallest id per fingerprint over links of all pairs of fingerprints."""
    values = sorted({p for _, p in prints})
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= distance and root(a) != root(b):
                parent[root(b)] = root(a)
    least = {}
    for i, p in prints:
        r = root(p)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return {v: least.get(root(v)) for v in values}


@pytest.mark.parametrize("source", ["odd", "documents"])
def test_near_duplicates(request, source):
    docs = request.getfixturevalue(source)
    rows = [(r.doc_id, slow_fingerprint(r.text or "")) for r in docs.select("doc_id", "text").collect()]
    expected = slow_components(rows)
    found = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in found) == Counter(
        (i, f"{p:016x}") for i, p in rows
    )
    for row in found:
        assert row.component_id == expected[int(row.fingerprint, 16)]


@pytest.mark.parametrize("parts,block", [((2,), 7), ((3,), 64), ((4,), 2), ((5,), 3)])
def test_links_lose_nothing_for_any_plan(spark, parts, block):
    """A dense cloud of near fingerprints beside spread ones, in tiny blocks."""
    rng = np.random.default_rng(3)
    spread = rng.integers(0, 2**63, 60, dtype=np.uint64).tolist()
    centre = spread[0]
    cloud = {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (60, 2))}
    values = sorted({*spread, *cloud})
    prints = spark.createDataFrame(
        [(int(np.uint64(v).view(np.int64)), i % 3) for i, v in enumerate(values)], "_fp bigint, _run int"
    )
    plan = simhash.plan_parts(prints, parts=parts)
    assert sum(t + 1 for _, t in plan) == 5
    edges = simhash.links(prints, plan, block=block)
    labels = {r["_fp"]: r["_label"] for r in simhash.components(edges).collect()}
    expected = slow_components([(int(np.uint64(v).view(np.int64)), v) for v in values])
    found = defaultdict(set)
    for v in values:
        signed = int(np.uint64(v).view(np.int64))
        found[labels.get(signed, signed)].add(v)
    wanted = defaultdict(set)
    for v in values:
        wanted[expected[v]].add(v)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, wanted.values()))


def test_allocation_is_the_cheapest():
    costs = [[0.0, 3.0, 4.0], [0.0, 1.0, 9.0], [0.0, 2.0, 2.5]]
    total, thresholds = simhash.allocate(costs, 3)
    assert (total, thresholds) == (3.5, [-1, 0, 1])


# --- mixing --------------------------------------------------------------------------


def test_mixing_odd_texts(odd, texts):
    found = mixing.mixed(odd).collect()
    assert len(found) == len(texts)
    sizes = Counter()
    for i, t, s in texts:
        sizes[s] += len(re.findall(WORD, t or ""))
    total = sum(sizes.values())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free = {}, set(order)
    while True:  # share, fix what is above its limit, share the rest again
        left = total - sum(target.values())
        heft = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / heft > 3 * sizes[s]]
        if not above:
            target.update({s: left * weight[s] / heft for s in free})
            break
        target.update({s: 3 * sizes[s] for s in above})
        free -= set(above)
    got = {(r.source_size, round(r.target, 6)) for r in found}
    assert got == {(sizes[s], round(float(target[s]), 6)) for s in order}
    assert all(r.taken % r.size == 0 and r.taken <= 3 * r.size for r in found if r.size)
    assert all(r.taken == 0 for r in found if not r.size)
    assert sum(r.taken for r in found) <= total


def test_mixed_documents_follow_their_copies(odd):
    mixed = mixing.mix_documents(odd)
    assert mixed.columns == odd.columns
    copies = Counter()
    for r in mixing.mixed(odd).collect():
        copies[r.doc_id] += r.taken // r.size if r.size else 0
    assert Counter(r.doc_id for r in mixed.collect()) == +copies


# --- packing -------------------------------------------------------------------------


@pytest.mark.parametrize("source", ["odd", "documents"])
def test_packing_round_trip(request, source):
    from tokenizers import Tokenizer

    docs = request.getfixturevalue(source)
    rows = docs.select("doc_id", "text").collect()
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    expected = Counter()
    for r in rows:
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        expected[r.doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    pieces = packing.packed(docs).collect()
    whole = [p for p in pieces if p.length == p.doc_tokens]
    left = expected - Counter((p.doc_id, p.doc_tokens, p.ids_crc32) for p in whole)
    assert sum(left.values()) + len(whole) == len(rows)
    cut = defaultdict(list)
    for p in pieces:
        if p.length != p.doc_tokens:
            cut[p.doc_id].append(p)
    by_id = {r.doc_id: r.text for r in rows}
    for doc_id, parts in cut.items():
        ids = np.array(
            [*tokenizer.encode(by_id[doc_id] or "", add_special_tokens=False).ids, 1], "<u4"
        )
        for p in parts:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for number, parts in sequences.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == packing.LENGTH or number == len(sequences) - 1


def test_packing_windows_keep_the_proportions(spark):
    """Two queues of 3:1; after every window each has had its share but for one document."""
    rows = [(i, "a" if i % 4 else "b", i * 7919 % 1000, 10 + i % 5, i) for i in range(4000)]
    sizes = spark.createDataFrame(
        [(r, False, s, h, n) for r, s, h, n, _ in rows],
        "_row bigint, _none boolean, _source string, _shuffle bigint, _n bigint",
    )
    window = 1000
    at = {r["_row"]: r["_at"] for r in packing.placed(sizes, window=window).collect()}
    total = sum(n for *_, n, _ in rows)
    share = {s: sum(n for _, x, _, n, _ in rows if x == s) / total for s in "ab"}
    for end in range(window, total, window):
        for s in "ab":
            served = sum(n for r, x, _, n, _ in rows if x == s and at[r] + n <= end)
            assert abs(served - share[s] * end) <= 3 * 14 + 2


def test_columns_of_the_operators_own_names_stay(spark):
    names = ["_row", "_ROW_", "_copy", "_copies", "_times", "_run", "_id", "_sha", "_fp", "_n"]
    prose = " ".join(f"word{k} and the rest of it," for k in range(40))
    rows = [(i, f"{prose} {i % 7}", "s", *[f"{n}{i}" for n in range(10)]) for i in range(40)]
    schema = "doc_id bigint, text string, source string, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame(rows, schema).repartition(3)
    given = {r.doc_id: tuple(r) for r in docs.collect()}
    for result in (exact.without_copies(docs), simhash.one_of_each(docs), mixing.mix_documents(docs)):
        found = result.collect()
        assert result.columns == docs.columns and found
        assert all(tuple(r) == given[r.doc_id] for r in found)
    assert exact.without_copies(docs).count() == 7


# --- classifier ----------------------------------------------------------------------


def test_classifier_learns_and_holds_out(spark, documents, folder):
    labels = table(spark, folder, "labels")
    found = {r.doc_id: r for r in classifier.quality_scores(documents, labels).collect()}
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    seen = [(r.quality, found[r.doc_id].predicted) for r in labels.collect() if r.doc_id in found]
    assert np.mean([a == b for a, b in seen]) > 0.9
    # Labels of held-out documents change nothing.
    flipped = labels.selectExpr(
        "doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 1 - quality, quality) AS quality"
    )
    again = {r.doc_id: r.score for r in classifier.quality_scores(documents, flipped).collect()}
    assert again == {i: r.score for i, r in found.items()}


def test_isotonic_is_monotone_and_keeps_the_mean():
    hits, rows = np.array([3.0, 0, 1, 5, 2]), np.array([4.0, 2, 2, 5, 4])
    levels = classifier.isotonic(hits, rows)
    assert (np.diff(levels) >= 0).all()
    assert (levels * rows).sum() == pytest.approx(hits.sum())


def test_summed_equations_equal_a_direct_solve(spark, documents, folder):
    """Over 300 partitions and lanes of 7, the weights of one solve over all rows."""
    stats = classifier.statistics_table(documents)
    labels = table(spark, folder, "labels")
    lane, classifier.LANE = classifier.LANE, 7
    try:
        model = classifier.fit(stats.repartition(300), labels)
    finally:
        classifier.LANE = lane
    answers = labels.where("quality IS NOT NULL AND crc32(string(doc_id)) % 5 <> 0")
    answers = answers.groupBy("doc_id").agg({"quality": "avg"}).withColumnRenamed("avg(quality)", "y")
    rows = stats.join(answers, stats["_id"] == answers["doc_id"]).selectExpr(
        "_stats", "y", "crc32(string(_id)) % 5 AS f"
    ).collect()
    late = Counter(r.y >= 0.5 for r in rows if r.f == 4)
    rows = [r for r in rows if r.f != 4 or min(late[True], late[False]) < 50]
    x = model.features(np.array([list(r._stats) for r in rows]))
    left = x.T @ x + classifier.RIDGE * len(rows) / classifier.WIDTH * np.eye(x.shape[1])
    assert np.allclose(np.linalg.solve(left, x.T @ np.array([r.y for r in rows])), model.weights, atol=1e-6)
    scores = model.score(np.array([list(r._stats) for r in rows]))
    order = np.argsort(model.raw(np.array([list(r._stats) for r in rows])))
    assert (np.diff(scores[order]) >= 0).all() and 0 <= scores.min() and scores.max() <= 1


def test_classifier_on_odd_texts_and_without_labels(odd, texts, labels):
    assert classifier.quality_scores(odd, labels).count() == len(texts)
    scores = classifier.quality_scores(odd, labels.where("false")).collect()
    assert {r.score for r in scores} == {0.5}
    assert classifier.accepted(odd, labels).columns == odd.columns


# --- quality rules -------------------------------------------------------------------


def slow_statistics(text):
    words = re.findall(WORD, text)
    seen = defaultdict(list)
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])].append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


@pytest.mark.parametrize("source", ["odd", "documents"])
def test_rule_statistics(request, spark, folder, source, labels):
    docs = request.getfixturevalue(source)
    given = labels if source == "odd" else table(spark, folder, "labels")
    expected = Counter()
    for r in docs.select("doc_id", "text").collect():
        s = slow_statistics(r.text or "")
        expected[r.doc_id, *s, s[0] < 20 or 100 * s[4] > 30 * s[0]] += 1
    found = rules.judged(docs, given).collect()
    assert expected == Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in found
    )
    assert not any(r.kept and r.base_failed for r in found)


def test_rules_are_learned(spark):
    """Low quality is a high symbol share, or many capitals in long texts."""
    rows = []
    for i in range(600):
        symbols, upper, words = (i * 37) % 100, (i * 53) % 100, 50 + (i * 71) % 400
        bad = symbols > 70 or upper > 80
        rows.append((i, words, 500, symbols * 5, 0, 0, words, upper * 5, 0, 0 if bad else 1))
    frame = spark.createDataFrame(
        rows,
        "_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, n_distinct_words bigint, n_upper bigint, n_stress bigint, quality int",
    )
    learned = rules.learn(
        frame.drop("quality"), frame.selectExpr("_id AS doc_id", "quality")
    )
    assert {name for rule in learned for name, *_ in rule} >= {"symbol_share", "upper_share"}
    wrong = frame.where(rules.verdict(learned) != (frame.quality == 1)).count()
    assert wrong < 30


# --- sharding ------------------------------------------------------------------------


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_shards(documents, law):
    given = {r.doc_id: r.text or "" for r in documents.collect()}
    found = sharding.sharded(documents, law).collect()
    assert sorted(r.doc_id for r in found) == sorted(given)
    slots, sizes = defaultdict(list), Counter()
    for r in found:
        raw = given[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), law)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size if law == "bytes" else 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in found) if law == "bytes" else 1
    assert max(sizes.values()) - min(sizes.values()) <= largest


def test_links_are_cut_less_than_at_the_start(spark):
    """Many small groups of copies: propagation brings most of them together."""
    docs = spark.createDataFrame(
        [(i, f"text {i % 300} " + "x" * (i % 300 % 7)) for i in range(900)]
        + [(1000 + i, f"alone {i}") for i in range(900)],
        "doc_id bigint, text string",
    )
    places = defaultdict(set)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in sharding.sharded(docs).collect():
        if r.doc_id < 900:
            places[texts[r.doc_id]].add(r.shard)
    assert sum(len(p) == 1 for p in places.values()) > 150


def test_quotas_keep_the_room():
    demand = {(0, 1): 50, (1, 0): 30, (2, 0): 10}
    allowed = sharding.quotas(demand, {0: 100, 1: 100, 2: 100}, 3, 0.1)
    assert allowed == {(0, 1): 40, (1, 0): 30, (2, 0): 10}


def test_odd_texts_in_shards(odd, texts):
    found = sharding.sharded(odd).collect()
    assert len(found) == len(texts) and {r.shard for r in found} <= set(range(8))


# --- personal data -------------------------------------------------------------------


def luhn(number):
    twice = [2 * int(c) if k % 2 else int(c) for k, c in enumerate(reversed(number))]
    return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0


def slow_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    checks = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (
            "ip",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            lambda m: all(int(p) <= 255 for p in m.split(".")),
        ),
        (
            "card",
            r"[0-9]([\x20-]?[0-9])+",
            lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)),
        ),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    )
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern, check in checks
        for m in re.finditer(pattern, text)
        if check(m[0])
    ]


@pytest.mark.parametrize("source", ["odd", "documents"])
def test_personal_data(request, source):
    docs = request.getfixturevalue(source)
    # The naive patterns are quadratic in runs of one character.
    rows = [r for r in docs.select("doc_id", "text").collect() if len(set(r.text or "ab")) > 1]
    expected = Counter((r.doc_id, ",".join(slow_spans(r.text or ""))) for r in rows)
    found = pii.personal_data(docs).collect()
    assert len(found) == docs.count()
    digests = Counter((r.doc_id, r.base_sha256) for r in found)
    for (doc_id, base), n in expected.items():
        assert digests[doc_id, hashlib.sha256(base.encode()).hexdigest()] >= n
    for r in found:
        listed = [s for s in r.spans.split(",") if s]
        own = [b for (i, b) in expected if i == r.doc_id]
        assert any(set(filter(None, b.split(","))) <= set(listed) for b in own or [""])
        assert len(listed) >= r.n_email + r.n_ip + r.n_card + r.n_phone


def test_candidates_like_cards_are_added(spark):
    """Numbers in the format and context of cards, but with a wrong check digit."""
    good = [n for n in (f"4{i:015d}" for i in range(123456789, 123466789, 7)) if luhn(n)][:120]
    rows = [(i, f"the card {n} of somebody") for i, n in enumerate(good)]
    wrong = next(n for n in range(4000001234567890, 4000001234567900) if not luhn(str(n)))
    rows += [(1000, f"the card {wrong} of somebody")]
    rows += [(2000 + i, f'token = "{hashlib.sha1(str(i).encode()).hexdigest()}"') for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert found[1000] == "card:9:25"
    assert not any(found[2000 + i] for i in range(60))


WIDER = {
    100_001: ("call me at 372 555-7739 today", "phone:11:23"),
    100_002: ("mail jo.doe [at] example [dot] org now", "email:5:34"),
    100_003: ("the card 4111.1111.1111.1111 of somebody", "card:9:28"),
    100_004: ("address 192,168,17,201 of it", "ip:8:22"),
    100_005: ("on the day 2024-05-17 and 1, 2, 3, 4 more", ""),
    100_006: ("mail äjo@example.org now", "email:5:20,email:6:20"),
}


@pytest.mark.parametrize("many", [True, False])
def test_wider_formats_are_added(spark, many):
    """Formats that no base pattern knows, beside many base spans and by themselves."""
    rows = [(i, text) for i, (text, _) in WIDER.items()]
    for i in range(150 if many else 0):
        a, b, c = 100 + 7 * i % 900, 200 + 11 * i % 800, 1000 + 37 * i % 9000
        rows += [
            (4 * i, f"call me at +1 ({a}) {b}-{c} today"),
            (4 * i + 1, f"mail a{i}.b@host{i % 9}.org now"),
            (4 * i + 2, f"address {i + 20}.{a % 156 + 100}.{b % 156 + 100}.{c % 256} of it"),
        ]
        number = f"4{c:04d}{a}{b}{c:04d}"
        rows += [(4 * i + 3, next(f"the card {number}{d} of it" for d in range(10) if luhn(f"{number}{d}")))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert {i: found[i] for i in WIDER} == {i: spans for i, (_, spans) in WIDER.items()}
    if many:  # addresses are no phone numbers
        assert all(found[4 * i + 2].startswith("ip") and "phone" not in found[4 * i + 2] for i in range(150))


def test_decoys_are_not_added(spark):
    """Numbers that are no such data, beside planted ones: precision and recall of what is added."""
    rows, wanted = [], {}
    for i in range(200):
        a, b, c = 200 + 7 * i % 700, 200 + 11 * i % 800, 1000 + 37 * i % 9000
        number = f"4{c:04d}{a}{b}{c:04d}"
        good = next(f"{number}{d}" for d in range(10) if luhn(f"{number}{d}"))
        bad = f"{number}{(int(good[-1]) + 1 + i % 9) % 10}"
        dotted = ".".join(good[k : k + 4] for k in range(0, 16, 4))
        for kind, text in (
            (None, f"the card {good} of it and order {bad} sent"),
            (None, f"item {bad} in box {a} {b} {c} there"),
            (None, f"lots 10,20,30,{i % 250} and {a} {c} {b} of 2024-05-17"),
            (None, f"call me at +1 ({a}) {b}-{c} or see {i % 250}.20.30.40 of it"),
            ("card", f"credit card {dotted} of it"),
            ("phone", f"my phone {a} {b}-{c} at home"),
            ("ip", f"server 192,168,{i % 250},17 of it"),
            (None, f"mail a{i}.b@host{i % 9}.org now"),
            ("email", f"mail jo{i} [at] host{i % 9} [dot] org now"),
        ):
            wanted[len(rows)] = kind
            rows.append((len(rows), text))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    base = {k: r.group() for k, t in rows if (r := re.search(r"^(?:the card|call me|mail a)", t))}
    got = {kind: [0, 0, 0] for kind in pii.KINDS}  # right, wrong, missed
    for r in pii.personal_data(docs).collect():
        n_base = r.n_email + r.n_ip + r.n_card + r.n_phone
        kinds = [s.split(":")[0] for s in r.spans.split(",") if s]
        assert not base.get(r.doc_id) or n_base
        added = kinds if not n_base else kinds[n_base:] if len(kinds) > n_base else []
        for kind in added:
            got[kind][0 if wanted[r.doc_id] == kind else 1] += 1
        if wanted[r.doc_id] and wanted[r.doc_id] not in kinds:
            got[wanted[r.doc_id]][2] += 1
    for kind, (right, wrong, missed) in got.items():
        assert right >= 0.95 * (right + wrong) and right >= 0.8 * (right + missed), (kind, got)


# --- pages ---------------------------------------------------------------------------

PAGE = (
    "<html><head><title>no</title><style>p{}</style></head><body class='x'>"
    "<nav><ul><li><a href='/'>menu</a></ul></nav><div class='cookie-notice'>cookies</div>"
    "<div class='post post-12'><h1>Title &amp; more</h1><p>First <b>bold</b>\n text<p>Second&nbsp;one"
    "<script>var a='<p>no</p>'</script><form><input><button>send</button></form>"
    "<p>Third, with commas, and dots.<br>After<!-- no --></div>"
    "<div id='comments'><p>reader says</p></div><aside>side</aside><footer>foot</footer></body></html>"
)
TEXT = "Title & more First bold text Second one Third, with commas, and dots. After"


def test_main_text_of_a_page_without_article():
    found = html.blocks(PAGE)
    assert html.best_container(found) == "html/body.x/div.post"
    assert html.main_text(found, []) == TEXT


ARTICLE = "<h1>Title</h1>" + "<p>Long words, and a sentence of prose. More of it here.</p>" * 8
NAV = "<nav><a href='/'>menu</a></nav>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><form id='aspnetForm'>{NAV}<div>{ARTICLE}</div><select><option>no</select></form>",
        f"<html><body><form>{NAV}<div>{ARTICLE}</div><div class='ad'>{'no ' * 60}</div></form>",
        f"<html><head><title>no</title><meta charset='utf-8'><body>{NAV}<div>{ARTICLE}</div>",
        f"<html><head><title>no</title><div>{ARTICLE}</div>",
        f"<html><body><div class='related'>{ARTICLE}</div><div class='ad'>no, no.</div>",
        *[
            f"<html><body>{NAV}<div class='{c}'>{ARTICLE}</div><div class='main-nav'>no</div></body></html>"
            for c in (
                "content has-sidebar",
                "entry no-sidebar",
                "post comments-open",
                "site has-banner",
                "commentary",
            )
        ],
    ],
)
def test_articles_in_marked_or_unclosed_elements_are_kept(page):
    inner = " ".join(re.sub("<[^>]*>", " ", ARTICLE).split())
    assert html.main_text(html.blocks(page), []) == inner


@pytest.mark.parametrize(
    "marks",
    ["main-nav", "site-footer", "mainNav", "comments-area", "commentlist", "ad-top", "cookie-notice",
     "x widget_text", "post-comments", "navbar", "sidebar-left", "advertisement"],
)
def test_marked_parts_are_left_out(marks):
    page = f"<html><body><div class='post'>{ARTICLE}<div class='{marks}'>no</div></div>"
    assert " no" not in html.main_text(html.blocks(page), [])
    assert not any(html.MARKS.search(c) for c in ("commentary", "content has-sidebar", "navy", "shared"))


LEAD = "<p>A lead of some length, which says what follows. It is no list of links, but prose.</p>"


@pytest.mark.parametrize(
    "whole",
    [
        f"<div class='post'><h1>Title</h1><div class='entry'>{ARTICLE}</div></div>",
        f"<div class='content'><div class='lead'>{LEAD * 2}</div><div class='body'>{LEAD * 5}</div></div>",
        f"<article><p>Some words before.</p><div><div class='body'>{ARTICLE}</div></div><p>And after.</p></article>",
        f"<div class='page'><h1>Title</h1><div class='main'><div class='body'>{ARTICLE}</div></div></div>",
        f"<div class='one'>{LEAD}</div><div class='two'>{LEAD * 2}</div><div class='three'>{LEAD * 6}</div>",
    ],
)
def test_an_article_in_several_parts_is_taken_whole(spark, whole):
    teasers = "<div class='more'>" + "<p><a href='/x'>no more of it, no</a></p>" * 5 + "</div>"
    page = f"<html><body>{NAV}{whole}<footer>no</footer></body></html>"
    inner = " ".join(re.sub("<[^>]*>", " ", whole).split())
    assert html.main_text(html.blocks(page), []) == inner
    if "<div class='one'>" not in whole:
        assert html.main_text(html.blocks(page.replace("<footer>", teasers + "<footer>")), []) == inner
    rows = [(i, f"http://h.example/{i}", page) for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.text for r in html.main_texts(pages).collect()} == {inner}


SHORT = "<p>Just a few words.</p>"
COOKIE = "<div class='cookie-notice'><h3>Cookies</h3><p>" + "We use cookies to make this site better for you. " * 5 + "</p></div>"
LOGIN = "<form class='f'><label>Name</label><input type='text'><input type='password'><p>Please log in to read all.</p></form>"
TOPICS = (
    "social-science", "share-price", "menu-ingredients", "login-guide", "promo", "related-work", "popup-book",
    "newsletter-body", "consent-decree", "widget-text",
)
LINKS = "<ul>" + "<li><a href='/x'>no more of it, no</a></li>" * 6 + "</ul>"
SECTION = f"<h2>Part</h2>{LEAD}"

# Pages and what is to be had of them: the markup of the text.
LAYOUTS = {
    "only a menu": (f"<nav>{LINKS}</nav><div class='menu'>no no</div>", ""),
    "only a footer": (f"<footer><h2>no</h2>{LEAD * 3}</footer>", ""),
    "only a footer by class": (f"<div class='site-footer'><h2>no</h2>{LEAD * 3}</div>", ""),
    "only a notice": (COOKIE, ""),
    "only a login": (LOGIN, ""),
    "short beside a notice": (f"<div class='post'>{SHORT}</div>{COOKIE}", SHORT),
    "short beside a login": (f"<div class='post'>{SHORT}</div>{LOGIN}", SHORT),
    "header in a post": (f"<div class='post'><header><h1>Top</h1></header>{LEAD * 4}</div><footer>no</footer>", "<h1>Top</h1>" + LEAD * 4),
    "header of the site": (f"<header><h1>no</h1>{NAV}</header><div class='post'>{ARTICLE}</div>", ARTICLE),
    "header around a menu": (f"<div class='wrap'><header><h1>no</h1>{NAV}</header>{ARTICLE}</div>", ARTICLE),
    **{f"topic {c}": (f"<div class='post'>{ARTICLE}<section class='{c}'>{SECTION}</section>{LEAD}</div>", ARTICLE + SECTION + LEAD) for c in TOPICS},
    "parts by name": (f"<div class='post'>{ARTICLE}<div class='share-buttons'>no</div><div class='related-posts'>{LINKS}</div>{LEAD}</div>", ARTICLE + LEAD),
    "a word alone": (f"<div class='post'>{ARTICLE}<div class='promo'>no, no</div>{LEAD}</div>", ARTICLE + LEAD),
    "a topic with controls": (f"<div class='post'>{ARTICLE}<div class='newsletter-x'><p>no</p><input></div>{LEAD}</div>", ARTICLE + LEAD),
    "lead beside links": (f"<div class='m'><h1>Top</h1>{LEAD}{LINKS}<div class='body'>{LEAD * 3}</div></div>{NAV}", "<h1>Top</h1>" + LEAD * 4),
    "a page-wide class": (f"<div class='sidebar-layout'>{ARTICLE}</div>", ARTICLE),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    body, inner = LAYOUTS[name]
    page = f"<html><head><title>no</title></head><body>{body}</body></html>"
    assert html.main_text(html.blocks(page), []) == " ".join(re.sub("<[^>]*>", " ", inner).split())


def test_layouts_with_a_host_vote(spark):
    rows = [
        (k, f"http://h{k // 3}.example/", f"<html><head><title>no</title></head><body>{body}</body></html>")
        for k, (body, _) in ((k, list(LAYOUTS.values())[k // 3]) for k in range(3 * len(LAYOUTS)))
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    inner = [" ".join(re.sub("<[^>]*>", " ", x).split()) for _, x in LAYOUTS.values()]
    found = html.main_texts(pages).collect()
    assert {r.page_id: r.text for r in found} == {k: inner[k // 3] for k, *_ in rows}


def test_two_layouts_on_a_host(spark):
    """A page whose article is in another element than the host's path keeps its article;
    a host path below the article does not cut its title."""
    box = f"<div class='box'>{ARTICLE}</div>"
    story = f"<div class='box'><p>no teaser, no.</p></div><div class='story'>{ARTICLE}</div>"
    inner = f"<div class='post'><div class='entry'>{ARTICLE}</div></div>"
    outer = f"<div class='post'><h1>Top</h1>{LEAD}<div class='entry'>{LEAD * 5}</div></div>"
    rows = [(k, "http://a/", box) for k in range(9)] + [(9, "http://a/", story)]
    rows += [(k, "http://b/", inner) for k in range(10, 19)] + [(19, "http://b/", outer)]
    rows = [(k, u, f"<html><body>{NAV}{b}<footer>no</footer></body></html>") for k, u, b in rows]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in html.main_texts(pages).collect()}
    text = lambda x: " ".join(re.sub("<[^>]*>", " ", x).split())
    assert found == {k: text("<h1>Top</h1>" + LEAD * 6 if k == 19 else ARTICLE) for k in range(20)}


def test_host_paths_against_a_slow_count(spark):
    """Many paths on one host; the same winners as a count of the votes."""
    rows = [(k, "h", f"<div class='x{chr(97 + k % 26)}{k % 3}y'><p>{'words, ' * 9}</p></div>") for k in range(200)]
    rows += [(k, "h", f"<div class='{'one' if k % 3 else 'two'}'>{ARTICLE}</div>") for k in range(300)]
    votes = Counter(html.best_container(html.blocks(h)) for *_, h in rows)
    slow = sorted((-n, p) for p, n in votes.items() if n >= 0.1 * sum(votes.values()))[: html.PATHS]
    table = spark.createDataFrame([(h, page) for _, h, page in rows], "_host string, _html string")
    assert [r._paths for r in html.host_paths(table).collect()] == [[p for _, p in slow]]


@pytest.mark.parametrize(
    "piece", ["<a ", '<a "', "<a '\"", "<a", "<!", "<?", "</a ", '<a x="<b y=\'', "<!--", "<a b=c "]
)
def test_tags_that_never_end_take_linear_time(piece):
    import time

    start = time.process_time()
    html.blocks(piece * (1_000_000 // len(piece)))
    assert time.process_time() - start < 2


def test_many_comments_are_no_article():
    page = f"<html><body><div class='post'>{ARTICLE}</div><div id='comments'>{'<p>no, no. </p>' * 200}</div>"
    assert "no, no" not in html.main_text(html.blocks(page), [])


def test_hosts_agree_on_a_path(spark):
    """A page whose own best container is wrong follows the other pages of its host."""
    poor = PAGE.replace("Third, with commas, and dots.", "").replace(
        "<footer>", "<div class='blurb'>" + "Long words, here. " * 40 + "</div><footer>"
    )
    rows = [(i, f"http://h.example/{i}", PAGE) for i in range(9)]
    rows += [(9, "http://h.example/9", poor), (10, None, None), (11, "x", ""), (11, "x", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages = pages.selectExpr("*", "1 AS text", "2 AS n_chars")
    found = html.main_texts(pages).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert texts[0] == TEXT and texts[9] == "Title & more First bold text Second one After"
    assert texts[10] == "" and texts[11] == ""
    assert all(r.n_chars == len(r.text) for r in found)


def test_pages_of_the_test_data(spark, folder):
    from html import unescape

    given = {r.page_id: r.html for r in table(spark, folder, "pages").collect()}
    for r in html.main_texts(table(spark, folder, "pages")).collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", given[r.page_id], re.S)[1]
        inner = re.sub(r"</?(p|h1|br|li|ul)[^>]*>", "\n", inner)
        assert r.text == " ".join(unescape(re.sub(r"</?[a-zA-Z][^>]*>", "", inner)).split())


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    """Files of small captures hold many, of large ones few or one; nothing is lost or changed."""
    sizes, url = ((120, 8), (2_000, 3), (None, 1)), "http://a/"
    rows = [(i, url, chr(97 + i % 26) * (11 + 37 * i)) for i in range(150)]
    rows += [(200 + i, url, rows[149][2]) for i in range(20)]  # revisits of the largest
    rows += [(300, "u" * 5_000, "long name")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    warc.write_archives(warc.captures(pages), f"{tmp_path}/warc", sizes)
    records = 0
    for raw in spark.read.format("binaryFile").load(f"{tmp_path}/warc").collect():
        blocks = [
            len(block.partition(b"\r\n\r\n")[2]) + 3 * len(h["warc-target-uri"])
            for h, block in warc.parse_records(raw.content)
            if "msgtype=response" in h["content-type"]
        ]
        records += len(blocks)
        assert any(
            len(blocks) <= together and max(blocks) <= (most or max(blocks))
            for most, together in sizes
        )
    assert records == len(rows)
    whole = Counter(tuple(r) for r in warc.archived(pages).collect())
    assert Counter(tuple(r) for r in warc.archived(pages, sizes=sizes).collect()) == whole


def _shuffled(plan):
    """Bytes of rows that the exchanges of a plan that has run have taken."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _shuffled(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return _shuffled(plan.plan())
    own = plan.metrics().apply("dataSize").value() if plan.nodeName() == "Exchange" else 0
    children = plan.children()
    return own + sum(_shuffled(children.apply(i)) for i in range(children.size()))


def test_archives_shuffle_a_payload_at_most_once(spark, tmp_path, monkeypatch):
    """However many classes of size there are, and where what is revisited is not broadcast."""
    sizes = ((2_000, 8), (4_000, 4), (8_000, 2), (None, 1))
    pages = spark.range(200).selectExpr(
        "id AS page_id", "'http://h/' AS url", "repeat(id, 50 + 100 * pmod(id, 40)) AS html"
    )
    pages = pages.union(pages.selectExpr("page_id + 1000", "url", "html").where("page_id > 149"))
    payload = pages.selectExpr("sum(octet_length(html))").first()[0]
    written, write_records = [], warc.records

    def watched(found):
        found.collect()
        written.append(_shuffled(found._jdf.queryExecution().executedPlan()))
        return write_records(found)

    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(warc, "records", watched)
        warc.write_archives(warc.captures(pages), f"{tmp_path}/warc", sizes)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert len(written) >= len(sizes)
    assert payload < sum(written) < 1.5 * payload
    kinds = Counter(r.type for r in warc.read_records(spark, f"{tmp_path}/warc").collect())
    assert kinds == {"response": 200, "revisit": 50, "request": 250, "metadata": 250}


def test_archives_of_very_long_pages(spark):
    """Pages of some 50 MB, two of them equal, have files of their own."""
    pages = spark.range(3).selectExpr(
        "id AS page_id", "'u' AS url", "repeat(concat('<p>', id % 2, ' text'), 5000000) AS html"
    )
    found = sorted(tuple(r) for r in warc.archived(pages).collect())
    sha = lambda i: hashlib.sha256(f"<p>{i} text".encode() * 5_000_000).hexdigest()
    size = 9 * 5_000_000
    assert found == [
        (0, size, sha(0), "response", None),
        (1, size, sha(1), "response", None),
        (2, size, sha(0), "revisit", 0),
    ]


def test_archives_of_odd_pages(spark):
    body = "<p>" + "text \r\n\r\n WARC/1.1 " * 20 + "ü</p>"
    rows = [
        (3, "http://a/", body),
        (2, "http://b/\r\nEvil: 1", body),
        (2, "http://b/", body),
        (None, None, body),
        (5, "u", "short"),
        (6, "u", "short"),
        (7, "", None),
        (8, None, ""),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = warc.archived(pages.selectExpr("*", "'x' AS record_type", "0 AS block").repartition(3))
    got = Counter(tuple(r) for r in found.collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    size = len(body.encode())
    assert got == Counter(
        [
            (2, size, sha(body), "response", None),
            (2, size, sha(body), "revisit", 2),
            (3, size, sha(body), "revisit", 2),
            (None, size, sha(body), "revisit", 2),
            (5, 5, sha("short"), "response", None),
            (6, 5, sha("short"), "response", None),
            (7, 0, sha(""), "response", None),
            (8, 0, sha(""), "response", None),
        ]
    )


# --- empty tables --------------------------------------------------------------------


def test_empty_tables(spark, no_docs, labels):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    for result in (
        exact.exact_duplicates(no_docs),
        simhash.near_duplicates(no_docs),
        mixing.mixed(no_docs),
        packing.packed(no_docs),
        classifier.quality_scores(no_docs, labels),
        rules.judged(no_docs, labels.where("false")),
        sharding.sharded(no_docs),
        pii.personal_data(no_docs),
        html.main_texts(pages),
        warc.archived(pages),
    ):
        assert result.collect() == []


@pytest.mark.parametrize(
    "page,text",
    [
        ("<div>" * 20_000 + "deep" + "</div>" * 20_000, "deep"),
        ("<b>x" * 20_000, "x" * 20_000),
        ("<div>" * 2_000 + "a" + "</i>" * 100_000, "a"),
        ("<article><p>a<div class='comments'><p>no<p>no</div><p>b</article>", "a b"),
    ],
)
def test_nested_and_unclosed_pages(page, text):
    found = html.blocks(page)
    assert max(path.count("/") for path, *_ in found) < html.DEEPEST
    assert html.main_text(found, []) == text

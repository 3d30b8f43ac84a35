"""Operators on documents against plain Python, on awkward rows."""

import hashlib
import itertools
import math
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import cases
from tierlake.llm import common, exact_dedup, fingerprints, jaccard_join, mixing, packing, sharding, shingles, substring_dedup
from tierlake.llm.components import components


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return cases.documents(spark, tmp_path_factory.mktemp("docs"))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return cases.nothing(spark, tmp_path_factory.mktemp("none"))


ROWS = cases.texts()


# Exact dedup


def largest(ids):
    return max(ids, key=lambda i: (i is not None, i or 0))


def test_exact_dedup_against_groups(docs):
    groups = defaultdict(list)
    for doc_id, text, _ in ROWS:
        groups[text or ""].append(doc_id)
    decided = exact_dedup.deduplicate(docs)[1].select("id", "keep.id", "size", "kept", F.hex("digest"))
    wanted = Counter()
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest().upper()
        wanted.update((i, largest(ids), len(ids), digest) for i in ids)
    found = [tuple(row) for row in decided.collect()]
    assert Counter((i, k, n, d) for i, k, n, _, d in found) == wanted
    assert sum(kept for *_, kept, _ in found) == len(groups)
    assert all(i == k for i, k, _, kept, _ in found if kept)


def test_exact_dedup_tells_texts_of_one_digest_apart(docs):
    weak = lambda content: F.unhex(F.substring(F.sha2(content, 256), 1, 2))
    strong, found = exact_dedup.deduplicate(docs)[1], exact_dedup.deduplicate(docs, digest=weak)[1]
    columns = ["id", "file", "row", "keep", "size", "kept"]
    assert cases.collected(found.select(columns)) == cases.collected(strong.select(columns))


def test_exact_dedup_goes_on_with_its_state(spark, docs, tmp_path):
    state = exact_dedup.DedupState(spark, str(tmp_path / "state"))
    first, second = (cases.documents(spark, tmp_path / name, ROWS[k::2]) for k, name in enumerate("ab"))
    for part in (first, second):
        state.ingest(exact_dedup.located(part), "doc_id", "text", bytes_per_batch=1)
    texts = Counter(text or "" for _, text, _ in ROWS)
    assert sorted(row.size for row in state.retained().select("size").collect()) == sorted(texts.values())


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_exact_dedup_checks_texts_of_earlier_runs(spark, tmp_path, order):
    # All texts have one digest; the state of the first run holds a text that the second run lacks.
    state = exact_dedup.DedupState(spark, str(tmp_path / "state"), lambda content: F.lit(b"same"))
    runs = [[(9, "alpha", None), (4, None, None)], [(1, "beta", None), (3, "alpha", None), (7, "", None)]]
    for number in order:
        part = exact_dedup.located(cases.documents(spark, tmp_path / f"run {number}", runs[number]))
        state.ingest(part, "doc_id", "text")
        decided = exact_dedup.decide(state, part, "doc_id", "text")
    found = {(row.id, row.keep.id, row["size"], row.kept) for row in decided.collect()}
    assert found == {(9, 9, 2, True), (3, 9, 2, False), (1, 1, 1, True), (4, 7, 2, False), (7, 7, 2, True)}


def test_exact_dedup_decides_over_all_runs_of_a_state(spark, tmp_path):
    state = exact_dedup.DedupState(spark, str(tmp_path / "state"))
    whole = cases.documents(spark, tmp_path / "whole", ROWS)
    wanted = exact_dedup.deduplicate(whole)[1]
    # Both runs read parts of the same files.
    for part in (whole.where("source = 's1'"), whole.where("source <> 's1' or source is null")):
        rows = exact_dedup.located(part)
        state.ingest(rows, "doc_id", "text")
    found = exact_dedup.decide(state, rows, "doc_id", "text")
    columns = ["id", "keep", "size", "kept", "digest"]
    assert cases.collected(found.select(columns)) == cases.collected(wanted.select(columns))


def test_exact_dedup_keeps_columns(docs, empty):
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(row.text or "" for row in kept.collect()) == sorted({text or "" for _, text, _ in ROWS})
    assert exact_dedup.keep_one(empty).count() == 0
    assert exact_dedup.deduplicate(empty)[1].count() == 0


# Sharding


def draw(doc_id, shard):
    seed = xxhash.xxh64(doc_id.to_bytes(8, "little", signed=True), 42).intdigest() if doc_id is not None else 42
    bits = xxhash.xxh64(shard.to_bytes(4, "little"), seed).intdigest() >> 11
    return -1 / math.log((bits + 0.5) / 2**53), shard


def test_sharding_against_python(docs, empty):
    found = sharding.assign(docs, 7).collect()
    wanted = Counter()
    for doc_id, text, _ in ROWS:
        content = (text or "").encode()
        wanted[doc_id, len(content) + 16, zlib.crc32(content), max(draw(doc_id, s) for s in range(7))[1]] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard) for r in found) == wanted
    by_shard = defaultdict(list)
    for row in found:
        by_shard[row.shard].append(row.slot)
        assert row.grown_shard in (row.shard, 7)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert sharding.assign(empty, 7).count() == 0


def test_weights_decide_how_much_a_shard_gets(spark):
    shards = sharding.shard_of(F.col("id"), {0: 1.0, 1: 3.0})
    counts = {r.s: r.n for r in spark.range(40_000).groupBy(shards.alias("s")).agg(F.count("*").alias("n")).collect()}
    assert 2.8 < counts[1] / counts[0] < 3.2
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), {0: 0.0})


# Fingerprints


def test_fingerprints_against_neighbours(docs, empty):
    # Rows of one identifier follow by file and row, which the table knows.
    place = F.struct("_metadata.file_path", "_metadata.row_index")
    meta = docs.select("doc_id", "text", docs.metadataColumn("_metadata").file_path.alias("f"), docs.metadataColumn("_metadata").row_index.alias("r"))
    rows = sorted(meta.collect(), key=lambda x: (x.doc_id is None, -(x.doc_id or 0), x.f, x.r))
    wanted = Counter()
    for k, row in enumerate(rows):
        text, other = row.text or "", rows[(k + 1) % len(rows)].text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        wanted[row.doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.fingerprint(text).text(), fingerprints.fingerprint(edited).text()] += 1
    found = fingerprints.fingerprints(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in found) == wanted
    assert all(0 <= x <= 1 for r in found for x in (r.near_edited, r.near_next))
    assert fingerprints.fingerprints(empty).count() == 0
    assert place is not None


def test_a_lone_document_is_its_own_neighbour(spark, tmp_path):
    row = fingerprints.fingerprints(cases.documents(spark, tmp_path, [(1, "ab\ncd", None)])).first()
    assert (row.near_next, row.n_chars) == (1.0, 5)
    assert row.edited_sha256 == hashlib.sha256(b"ab\nab").hexdigest()


def test_pieces_are_added_and_taken_out_in_any_order():
    one = fingerprints.Vector().add(["a", "b", "b", "c"])
    other = fingerprints.Vector().add(["b", "c"]).add(["x", "a"]).add(["b"]).add(["x"], -1)
    assert one.text() == other.text()
    assert fingerprints.Vector.from_text(one.text()).packed() == one.packed()
    assert fingerprints.likeness(one, other) == 1.0
    assert fingerprints.likeness(one, fingerprints.Vector().add(["a", "b", "c"])) < 1.0


@pytest.mark.parametrize("size", [20, 300, 5000])
def test_likeness_follows_jaccard(size):
    shared = [f"shared {k}" for k in range(size)]
    for extra in (size // 10, size // 2, 2 * size):
        a = fingerprints.Vector().add(shared + [f"a{k}" for k in range(extra)])
        b = fingerprints.Vector().add(shared + [f"b{k}" for k in range(extra)])
        assert abs(fingerprints.likeness(a, b) - size / (size + 2 * extra)) < 0.17


@pytest.mark.parametrize("lines, often", [(1, 1000), (1, 30), (10, 100), (1, 10**5)])
def test_repeated_pieces_count_as_often_as_they_occur(lines, often):
    a, b = ([f"{name} {k}" for k in range(lines)] * often for name in "ab")
    assert fingerprints.likeness(fingerprints.Vector().add(a), fingerprints.Vector().add(b)) < 0.25
    both = fingerprints.Vector().add(a).add(b), fingerprints.Vector().add(a).add(b[: len(b) // 2])
    assert abs(fingerprints.likeness(*both) - 0.75) < 0.1


@pytest.mark.parametrize("size", [10**5, 10**6])
def test_likeness_of_very_long_texts(size):
    shared = fingerprints.Vector().add(f"shared {k}" for k in range(size))
    a, b = (fingerprints.Vector().add(f"{name} {k}" for k in range(size)) for name in "ab")
    assert fingerprints.likeness(a, b) < 0.25
    a.wide, a.sparse = a.wide + shared.wide, a.sparse + shared.sparse
    b.wide, b.sparse = b.wide + shared.wide, b.sparse + shared.sparse
    assert abs(fingerprints.likeness(a, b) - 1 / 3) < 0.17


# Mixing


def test_mixing_meets_targets(docs, empty):
    found = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for _, text, source in ROWS:
        sizes[source] += len(cases.words(text))
    targets = python_targets(sizes)
    assert Counter((r.doc_id, r.size) for r in found) == Counter((i, len(cases.words(t))) for i, t, _ in ROWS)
    by_number = defaultdict(list)
    for row in found:
        assert 0 <= row.copies <= 2
        by_number[row.number].append(row)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    for number, source in enumerate(order):
        rows = by_number[number]
        assert rows[0].source_size == sizes[source]
        assert rows[0].target == pytest.approx(targets[source], rel=1e-9)
        longest = max(row.size for row in rows)
        assert abs(sum(row.size * row.copies for row in rows) - targets[source]) <= longest
    assert cases.collected(mixing.mix(docs).select("doc_id", "copies")) == cases.collected(mixing.mix(docs).select("doc_id", "copies"))
    assert mixing.mix(empty).count() == 0


def test_mixed_takes_documents_that_are_in_no_file(spark):
    rows = [(k, "some words " * (k % 7 + 1), f"s{k % 3}") for k in range(60)]
    made = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    wanted = Counter()
    for row in mixing.mix(made).collect():
        wanted[row.doc_id] += row.copies
    assert sum(wanted.values()) > 0
    assert Counter(r.doc_id for r in mixing.mixed(made).collect()) == +wanted
    grouped = made.groupBy("doc_id", "source").agg(F.first("text").alias("text"))
    assert Counter(r.doc_id for r in mixing.mixed(grouped).collect()) == +wanted


def python_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    left, free, target = share * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= most * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in free}
        target |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return target


def test_rates_are_the_exponential_tilt(docs):
    rows = mixing.mix(docs).where("size > 0").collect()
    by_source = defaultdict(list)
    for row in rows:
        by_source[row.number].append(row)
    for own in by_source.values():
        mean = sum(r.size for r in own) / len(own)
        tilts = {round(math.log(r.rate) / (r.size / mean), 6) for r in own if 1e-12 < r.rate < 2}
        assert len(tilts) <= 1
        assert sum(r.rate * r.size for r in own) == pytest.approx(own[0].target, rel=1e-6)


def test_the_balance_stores_no_table_per_step(docs, monkeypatch):
    """However many Newton steps it takes, the driver plans and runs the mix as a few jobs."""
    purposes, store = [], mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda frame, purpose: (purposes.append(purpose), store(frame, purpose))[1])
    mixing.mix(docs)
    assert len(purposes) <= 6


def test_mixed_rows_are_repeated(docs, empty):
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == mixing.mix(docs).agg(F.sum("copies")).first()[0]
    assert mixing.mixed(empty).count() == 0


# Jaccard join


def python_components(rows, width=5, percent=75):
    sets = []
    for _, text, _ in rows:
        tokens = cases.words((text or "").translate(cases.ASCII_LOWER))
        sets.append({tuple(tokens[k : k + width]) for k in range(max(1, len(tokens) - width + 1))} if tokens else set())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    members = defaultdict(list)
    for k in range(len(rows)):
        members[find(k)].append(rows[k][0])
    least = {k: min((i for i in ids if i is not None), default=None) for k, ids in members.items()}
    return Counter((rows[k][0], len(sets[k]), least[find(k)]) for k in range(len(rows)))


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_jaccard_join_against_all_pairs(docs, monkeypatch, rounds):
    """However many rounds of regions there are, the boundaries complete the result."""
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    found = jaccard_join.join(docs)[1].collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == python_components(ROWS)


def crowd(count, seed=1):
    """Copies of a text with words left out or changed, most of them too far from each other to link."""
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(count):
        words, edits = list(base), int(rng.integers(1, 12))
        for at in sorted(rng.choice(len(words), edits, replace=False), reverse=True):
            if rng.random() < 0.7:
                del words[at]
            else:
                words[at] = f"x{rng.integers(0, 40)}"
        rows.append((k, " ".join(words), None))
    return rows


def matrix_components(rows):
    """Components from all intersections at once."""
    sets = [set(zip(*(text.split()[k:] for k in range(5)), strict=False)) for _, text, _ in rows]
    number = {shingle: k for k, shingle in enumerate(sorted(set().union(*sets)))}
    incidence = np.zeros((len(sets), len(number)), np.float32)
    for k, own in enumerate(sets):
        incidence[k, [number[shingle] for shingle in own]] = 1
    both, sizes = incidence @ incidence.T, incidence.sum(axis=1)
    linked = 100 * both >= 75 * (sizes[:, None] + sizes[None, :] - both)
    least = np.arange(len(rows))
    while True:
        lower = np.where(linked, least[None, :], len(rows)).min(axis=1)
        if (lower == least).all():
            share = float(linked.mean())
            return {k: int(root) for k, root in enumerate(least)}, share
        least = lower


def test_a_crowd_is_joined_without_pairing_all_of_it(spark, tmp_path, monkeypatch):
    """Pairs that are formed and verified grow with the sets, not with their square."""
    rows, counted = crowd(2000), []
    wanted, share = matrix_components(rows)
    assert 0.01 < share < 0.4 and len(set(wanted.values())) > 100
    for name in ("overlaps", "boundary_pairs"):
        made = getattr(jaccard_join, name)

        def counts(*arguments, made=made, name=name):
            found = made(*arguments)
            counted.append((name, (found if name == "boundary_pairs" else arguments[0]).count()))
            return found

        monkeypatch.setattr(jaccard_join, name, counts)
    found = jaccard_join.join(cases.documents(spark, tmp_path, rows))[1].collect()
    assert {r.doc_id: r.component_id for r in found} == wanted
    assert sum(n for _, n in counted) < 20 * len(rows)


def test_rows_without_identifier_give_way_in_their_group(spark, tmp_path):
    text = "some words that make up one text of two rows"
    kept = jaccard_join.keep_one(cases.documents(spark, tmp_path, [(None, text, "a"), (5, text, "b"), (7, text, "c"), (None, "alone", "d")]))
    assert cases.collected(kept.select("doc_id", "source")) == sorted([(5, "b"), (None, "d")], key=repr)


def test_jaccard_join_with_all_shingles_common(docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "COMMON_LEAST", 0)
    found = jaccard_join.join(docs)[1].collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == python_components(ROWS)


def test_jaccard_join_removes_what_it_no_longer_reads(docs, tmp_path, monkeypatch):
    made = itertools.count()
    monkeypatch.setattr(common, "scratch_folder", lambda _, purpose: f"{tmp_path}/scratch/{purpose}-{next(made)}")
    found = jaccard_join.join(docs)[1]
    left = {path.name.rpartition("-")[0] for path in tmp_path.glob("scratch/*")}
    assert "join-documents" in left and not left & {"join-profiles", "join-cells", "join-distinct-cells", "join-sets"}
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == python_components(ROWS)


def test_jaccard_join_sends_small_batches_to_python(spark, tmp_path, monkeypatch):
    """A batch may hold two whole sets a row, so its rows are few; the session's own settings come back."""
    size, sizes, store = "spark.sql.execution.arrow.maxRecordsPerBatch", [], jaccard_join.stored
    before = spark.conf.get(size)
    monkeypatch.setattr(jaccard_join, "stored", lambda frame, purpose: (sizes.append(int(spark.conf.get(size))), store(frame, purpose))[1])
    jaccard_join.join(cases.documents(spark, tmp_path, [(1, "a few words", "s"), (2, "some other words", "s")]))
    assert sizes and max(sizes) <= 1024 and spark.conf.get(size) == before


def test_workers_remember_few_words(monkeypatch):
    """What a Python worker keeps for the rest of the session stays below 32 MB, however many words it has met."""
    monkeypatch.setattr(shingles, "HASHES", shingles.WordHashes())
    for start in range(0, 450_000, 50_000):
        words = b" ".join(b"some-word-%d" % k for k in range(start, start + 50_000))
        hashes = shingles.word_hashes(words)
    assert hashes[-1] == xxhash.xxh3_64_intdigest(b"some-word-449999")
    held = shingles.HASHES
    assert sys.getsizeof(held) + sum(sys.getsizeof(word) + sys.getsizeof(value) for word, value in held.items()) < 32 << 20


def test_numbering_starts_no_python_workers(docs, empty):
    """The table of files comes from Arrow: rows of Python objects are made by workers that then stay."""
    rows = common.numbered(docs)
    assert "ExistingRDD" not in rows.frame._jdf.queryExecution().toString()
    numbers = sorted(row[0] for row in rows.frame.select(rows.row).collect())
    assert numbers == list(range(rows.total)) and rows.total == docs.count()
    assert common.numbered(empty).frame.count() == 0


def test_whole_sets_are_sent_only_for_near_pairs(spark):
    """Of a hundred sets that share a few shingles with a centre, and one that shares most, only that one is compared whole."""
    rng, rule = np.random.default_rng(3), jaccard_join.Rule()
    centre = np.unique(rng.integers(0, 2**63, 600, dtype=np.uint64))
    others = [np.unique(np.r_[centre[:60], rng.integers(0, 2**63, 540, dtype=np.uint64)]) for _ in range(100)]
    others.append(np.unique(np.r_[centre[:420], rng.integers(0, 2**63, 150, dtype=np.uint64)]))
    rows = [(bytearray([k]), len(x), bytearray(x.tobytes())) for k, x in enumerate([centre, *others])]
    sets = spark.createDataFrame(rows, "node binary, n bigint, shingles binary")
    pairs = spark.createDataFrame([(bytearray([k]), bytearray([0])) for k in range(102)], "a binary, b binary")
    near = jaccard_join.nearby(pairs, sets, rule)
    assert sorted(row.a[0] for row in near.collect()) == [0, 101]
    exact = {row.a[0]: (row.both, row.only is not None) for row in jaccard_join.differences(near, sets, rule).collect()}
    assert exact == {0: (600, True), 101: (420, True)}


def test_differences_that_all_sets_share_pair_none_of_them(spark, monkeypatch):
    """All sets of a region lack the same shingles of its centre; only those that can link are compared."""
    rng, rule, counted = np.random.default_rng(4), jaccard_join.Rule(), []
    values = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64))
    centre, fresh, made = values[:140], values[140:], [values[:140]]
    for k in range(200):
        kept = np.r_[centre[:2], rng.choice(centre[5:], 100 if k % 2 else 125, replace=False)]
        made.append(np.r_[kept, rng.choice(fresh, 30 if k % 2 else 5, replace=False)])
        if k % 20 == 1:
            made.append(np.r_[made[-1][:-2], rng.choice(fresh, 2)])
    made = [np.unique(x) for x in made]
    node = lambda k: bytearray(k.to_bytes(2, "big"))
    sets = spark.createDataFrame([(node(k), len(x), bytearray(x.tobytes())) for k, x in enumerate(made)], "node binary, n bigint, shingles binary")
    regions = jaccard_join.differences(spark.createDataFrame([(node(k), node(0)) for k in range(len(made))], "a binary, b binary"), sets, rule)
    regions = jaccard_join.stored(regions.where("only is not null"), "test-regions")
    alike = lambda x, y: 100 * len(both := np.intersect1d(x, y)) >= 75 * (len(x) + len(y) - len(both))
    named = [0 if alike(x, centre) else k for k, x in enumerate(made)]
    labels = spark.createDataFrame([(node(k), node(label)) for k, label in enumerate(named)], "node binary, label binary")
    compare = jaccard_join.together
    monkeypatch.setattr(jaccard_join, "together", lambda pairs, sets: (counted.append(pairs.count()), compare(pairs, sets))[1])
    found = {frozenset((bytes(r.a), bytes(r.b))) for r in jaccard_join.links_within(regions, labels, rule).collect()}
    inside = {int.from_bytes(r.a, "big") for r in regions.collect()}
    wanted = {
        frozenset((bytes(node(j)), bytes(node(k)))) for j in inside for k in inside
        if j < k and named[j] != named[k] and alike(made[j], made[k])
    }
    assert found == wanted and wanted
    assert len(wanted) <= sum(counted) < 500


def test_jaccard_join_keeps_one_of_each_group(docs, empty):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {(n, c) if n else (i, None) for i, n, c in python_components(ROWS)}
    wordless = sum(not cases.words(text) for _, text, _ in ROWS)
    components_found = {c for i, n, c in python_components(ROWS) if n}
    assert kept.count() == len(components_found) + wordless
    assert groups and jaccard_join.keep_one(empty).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(60)]
    star = [(100, k) for k in range(101, 160)]
    edges = spark.createDataFrame([*path, *star, (200, 200), (301, 300)], "a bigint, b bigint")
    found = {row.node: row.root for row in components(edges).collect()}
    assert {found[k] for k in range(61)} == {0} and {found[k] for k in range(100, 160)} == {100}
    assert found[300] == found[301] == 300 and 200 not in found


# Substring dedup


def python_removed(rows, window=35):
    counts = Counter()
    tokens = [cases.words(text) for _, text, _ in rows]
    for own in tokens:
        counts.update(tuple(own[k : k + window]) for k in range(len(own) - window + 1))
    result = Counter()
    for (doc_id, *_), own in zip(rows, tokens, strict=True):
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            if counts[tuple(own[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = " ".join(w for w, drop in zip(own, gone, strict=True) if not drop)
        result[doc_id, len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return result


def test_substring_dedup_against_all_windows(docs, empty):
    found = substring_dedup.cleaned(docs, with_text=True).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == python_removed(ROWS)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in found)
    assert substring_dedup.cleaned(empty).count() == 0


@pytest.mark.parametrize("repeats", [34, 35, 36, 69, 70, 200])
def test_substring_dedup_within_a_document(spark, tmp_path, repeats):
    rows = [(1, "again " * repeats, None), (2, "fresh words " * 10 + " ".join(f"w{k}" for k in range(50)), None)]
    found = substring_dedup.cleaned(cases.documents(spark, tmp_path, rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == python_removed(rows)


def test_every_shift_of_a_match_meets_the_cover():
    cover = substring_dedup.Cover()
    on = set(cover.positions(500).tolist())
    for a in range(cover.period):
        for b in range(cover.period):
            assert any(a + s in on and b + s in on for s in range(cover.period))
    with pytest.raises(ValueError):
        substring_dedup.Cover(cover=(0, 1, 2))


# Packing


TOKENIZER = packing.default_tokenizer()


def test_tokens_are_those_of_the_whole_text():
    from tokenizers import Tokenizer

    from tierlake.llm.tokens import token_ids

    whole = Tokenizer.from_file(TOKENIZER)
    odd = ["don't 'tis (it's) ''s %%%'s I'LL", "<|endoftext|>a <|startoftext|>", "é ß ẞ İI ÷×µ Ÿ é", "a b c\x1cd\x85e", "数字 １２ ½", "'S'T'RE ǅ ﬁ ſ", ""]
    for text in odd + [t or "" for _, t, _ in ROWS]:
        assert token_ids(text, TOKENIZER).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_tokenizers_that_cut_otherwise_get_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    from tierlake.llm.tokens import token_ids, tokens_of

    given, other = (str(public_tokenizers.path(name)) for name in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    assert tokens_of(given)[2] and not tokens_of(other)[2]
    whole = Tokenizer.from_file(other)
    for text in ("Two  words\n\nand It's 1234 more", "", " ", "é ß\u00a0x <|endoftext|> y", "word " * 3000):
        assert token_ids(text, other).tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_round_trip(docs, empty, capacity):
    from tokenizers import Tokenizer

    whole, wanted = Tokenizer.from_file(TOKENIZER), Counter()
    for doc_id, text, _ in ROWS:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            wanted[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    found = packing.pack(docs, TOKENIZER, capacity).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == wanted
    check_places([(r.sequence_id, r.offset, r.length) for r in found], capacity)
    assert packing.pack(empty, TOKENIZER, capacity).count() == 0


def check_places(places, capacity):
    sequences = defaultdict(list)
    for sequence, offset, length in places:
        sequences[sequence].append((offset, length))
    for content in sequences.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def planned(counts, capacity):
    table, places, taken = packing.plan(counts, capacity), [], Counter()
    lengths = table["length"].to_numpy()
    for length, n in counts.items():
        own = table[lengths == length]
        for rank in range(n):
            run = own[own["rank"] <= rank].iloc[-1]
            at = rank - run["rank"]
            places.append((run["sequence"] + at // run["each"], run["offset"] + at % run["each"] * length, length))
            taken[length] += 1
    return check_places(places, capacity)


def test_plans_place_every_piece_once(rng=np.random.default_rng(3)):
    for capacity in (10, 37, 100):
        for _ in range(15):
            counts = Counter(rng.integers(1, capacity + 1, rng.integers(1, 80)).tolist())
            bins = planned(counts, capacity)
            total = sum(k * n for k, n in counts.items())
            assert -(-total // capacity) <= bins <= 1 + 11 / 9 * max(-(-total // capacity), sum(n for k, n in counts.items() if 2 * k > capacity))


def least_bins(pieces, capacity):
    best = [len(pieces)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(pieces):
            best[0] = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= pieces[k]:
                rest = list(rooms)
                rest.remove(room)
                place(k + 1, [*rest, room - pieces[k]])
        place(k + 1, [*rooms, capacity - pieces[k]])

    place(0, [])
    return best[0]


def test_dominance_loses_no_best_packing(rng=np.random.default_rng(9)):
    """The fixed sets and a best packing of the rest are together a best packing."""
    for _ in range(120):
        capacity = int(rng.integers(8, 20))
        pieces = sorted(rng.integers(1, capacity + 1, rng.integers(2, 9)).tolist(), reverse=True)
        left = packing.Lengths(dict(Counter(pieces)))
        fixed = sum(bins.count for bins in packing.reduce(left, capacity))
        rest = sorted((k for k, n in left.counts.items() for _ in range(n)), reverse=True)
        assert fixed + (least_bins(rest, capacity) if rest else 0) == least_bins(pieces, capacity)

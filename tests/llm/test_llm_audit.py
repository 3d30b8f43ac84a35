"""The byte transducer against regular expressions, and the filter audit against every order played through."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from tierlake.llm import filter_audit, transducer

ALPHABET = "abcAZ é數😀 \t\n\x0b#$|\x85\xa0\x1c"


def plain(text):
    words = cases.words(text)
    return len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))


def found(texts):
    counts = transducer.measure([text.encode() for text in texts])
    return [tuple(row) for row in np.stack([getattr(counts, name) for name in filter_audit.COUNTED], axis=1).tolist()]


@pytest.mark.parametrize("block", [16, 64, 1 << 20])
def test_transducer_against_regular_expressions(monkeypatch, block):
    monkeypatch.setattr(transducer, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(40):
        texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.choice([0, 1, 5, 50, 400]))) for _ in range(rng.randint(0, 12))]
        assert found(texts) == [plain(text) for text in texts]


def test_transducer_on_very_long_texts():
    texts = ["", "x" * 3_000_000, "a b " * 600_000, "abcdefgh abcdefghi abcdefgx abcdefgh", " " * 2_000_000 + "end"]
    assert found(texts) == [plain(text) for text in texts]


def test_words_that_share_a_hash_are_told_apart():
    content = np.frombuffer(b"aaaaaaaaa aaaaaaaab aaaaaaaaa ab ", np.uint8)
    table, zero = transducer.SpanTable(content), np.zeros(4, np.uint64)
    first = table.insert(np.zeros(4, np.int64), np.array([0, 10, 20, 30]), np.array([9, 9, 9, 2]), zero)
    assert first.tolist() == [True, True, False, True]
    again = table.insert(np.array([0, 1]), np.array([10, 10]), np.array([9, 9]), zero[:2])
    assert again.tolist() == [False, True]


def played(rows, labels):
    """The audit row by row: every order is applied to every part, document by document."""
    told = defaultdict(lambda: [False, False])
    for doc_id, good, toxic in labels:
        if doc_id is not None:
            told[doc_id][0] |= good == 1
            told[doc_id][1] |= toxic == 1
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    parts = defaultdict(list)
    for doc_id, text, source in rows:
        words, distinct, capitals, points, symbols = plain(text or "")
        fails = {
            "A": words < 200, "B": 100 * distinct < 50 * words, "C": 100 * capitals > 2 * points, "D": symbols > 0,
            "E": doc_id is not None and least[text or ""] < doc_id,
        }
        good, toxic = told[doc_id] if doc_id is not None else (False, False)
        parts[source or ""].append(({name for name in fails if fails[name]}, good, toxic))
    result = {}
    removed_in_all = Counter()
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = docs
            for step, name in enumerate(order, 1):
                gone = [doc for doc in left if name in doc[0]]
                left = [doc for doc in left if name not in doc[0]]
                removed_in_all[part, name] += len(gone)
                result[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in doc[0] for doc in docs) - len(gone), sum(doc[0] == {name} for doc in docs),
                    sum(doc[1] for doc in gone), sum(doc[2] for doc in gone),
                ]
    return {key: (*value, removed_in_all[key[0], key[1][key[2] - 1]]) for key, value in result.items()}


def audited(frame):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in frame.collect()}


def test_audit_against_every_order_played_through(spark, tmp_path):
    rows = cases.texts()
    rows += [(900 + k, "Some Words HERE " * n + mark, "s1") for k, (n, mark) in enumerate([(3, ""), (80, "#"), (80, ""), (80, "")])]
    rows += [(950, " ".join(f"w{k}" for k in range(300)), None), (951, " ".join(f"w{k}" for k in range(300)), ""), (952, "|" * 300, "s1")]
    labels = [(i, k % 3 if k % 4 else None, k % 2) for k, (i, *_) in enumerate(rows)] + [(rows[0][0], 1, None), (None, 1, 1)]
    table = spark.createDataFrame([(*row, "x", 1) for row in labels], "doc_id bigint, quality int, toxic int, part string, n int")
    docs = cases.documents(spark, tmp_path, rows)
    found_rows = filter_audit.audit(docs, table)
    assert found_rows.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert audited(found_rows) == played(rows, labels)


def test_audit_of_nothing(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(cases.nothing(spark, tmp_path), labels).count() == 0
    (tmp_path / "one").mkdir()
    one = filter_audit.audit(cases.documents(spark, tmp_path / "one", [(None, None, None)]), labels)
    assert one.count() == 600 and audited(one) == played([(None, None, None)], [])


def test_audit_of_other_filters(spark, tmp_path):
    own = [filter_audit.Filter("S", F.col("points") < 50), filter_audit.Filter("W", F.col("words") > 2)]
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = cases.documents(spark, tmp_path, [(1, "a b c", "x"), (2, "long" * 30, "x"), (3, "a", "x"), (4, "one two three " * 9, "x")])
    found_rows = audited(filter_audit.audit(docs, labels, own))
    assert {key[1:]: value[:4] for key, value in found_rows.items()} == {
        ("SW", 1): (2, 2, 0, 1), ("SW", 2): (1, 1, 1, 1), ("WS", 1): (2, 2, 0, 1), ("WS", 2): (1, 1, 1, 1),
    }

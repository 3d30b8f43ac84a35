"""Small tables with every awkward row, and plain Python versions of the operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {code: code + 32 for code in range(65, 91)}
#: Names that operators use inside; documents may have them as well.
CLASHING = ["_file", "_row", "digest", "keep", "size", "content", "file", "row", "rid", "node", "label", "score", "copies"]
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"{name} string" for name in CLASHING
)


def words(text):
    return WORD.findall(text or "")


def texts(seed=5):
    """(doc_id, text, source) with nulls, empty and long texts, exact and near copies, shared passages."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    joined = lambda tokens: "".join(t + rng.choice(["  ", " ", " ", ".\n", "\t"]) for t in tokens)
    passage, rows = prose(60), []
    for number in range(40):
        own = prose(rng.randint(1, 120))
        if number % 5 == 0:
            own = own[:20] + passage + own[20:]
        rows.append(joined(own).strip())
    base = prose(150)
    for _ in range(25):
        edited = list(base)
        for _ in range(rng.randint(0, 9)):
            edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
        rows.append(" ".join(edited))
    rows += [rows[3]] * 12 + [rows[0].upper(), " ".join(prose(30_000)), None, None, "", " \n\t ", "one", "one two three four", "x" * 20_000]
    rows.append(rows[-4])
    order = list(range(len(rows)))
    rng.shuffle(order)
    made = [(order[k], text, f"s{order[k] % 5}" if order[k] % 7 else None) for k, text in enumerate(rows)]
    # A repeated row, and rows without an identifier.
    return [*made, made[2], (2**62 + 1, "large number here", "s2"), (None, "nameless text of several words here", "s1"), (None, None, "s1")]


def documents(spark, folder, rows=None, parts=3):
    """The rows as a stored table with clashing columns."""
    rows = texts() if rows is None else rows
    filled = [(i, t, "en", s, len(t or ""), *["clash"] * len(CLASHING)) for i, t, s in rows]
    path = str(folder / "documents.parquet")
    spark.createDataFrame(filled, DOCUMENTS).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def nothing(spark, folder):
    return documents(spark, folder, [])


def collected(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)

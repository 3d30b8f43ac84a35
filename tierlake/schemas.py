"""Schemas of the landed entities and of the written quality reports.

Explicit schemas spare a pass over the landing files and keep nested fields in
source order, which inference does not.
"""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, TEXT, FLAG, DOUBLE = (
    T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.DoubleType(),
)


def fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


USERS = fields(
    id=LONG,
    name=TEXT,
    username=TEXT,
    email=TEXT,
    address=fields(street=TEXT, suite=TEXT, city=TEXT, zipcode=TEXT, geo=fields(lat=TEXT, lng=TEXT)),
    phone=TEXT,
    website=TEXT,
    company=fields(name=TEXT, catchPhrase=TEXT, bs=TEXT),
)
POSTS = fields(userId=LONG, id=LONG, title=TEXT, body=TEXT)
TODOS = fields(userId=LONG, id=LONG, title=TEXT, completed=FLAG)
COMMENTS = fields(postId=LONG, id=LONG, name=TEXT, email=TEXT, body=TEXT)

ENTITIES = {"users": USERS, "posts": POSTS, "todos": TODOS, "comments": COMMENTS}

_CHECK = dict(check=TEXT, dimension=TEXT, status=TEXT, details=TEXT, severity=TEXT, failing=LONG)

RESULT = fields(
    entity=TEXT, layer=TEXT, position=INT, **_CHECK,
)

# Entity and layer are the partition of a report, not part of its file.
REPORT = fields(
    score=DOUBLE,
    timestamp=TEXT,
    summary=fields(passed=LONG, failed=LONG, warnings=LONG),
    checks=T.ArrayType(fields(**_CHECK)),
    entity=TEXT,
    layer=TEXT,
)

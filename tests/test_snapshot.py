"""Snapshot differences against a plain multiset difference, and what is read."""

import random
import re
from collections import Counter

from conftest import SF_SMALL, plan_text
from matchlake.operators import snapshot as S
from matchlake.plans import star
from matchlake.session import work_dir

SCHEMA = "id long, a int, b string"


def written(spark, rows, width=10):
    path = work_dir(spark, "snapshot-test")
    df = spark.createDataFrame(rows, SCHEMA)
    S.write_snapshot(df, path, "id", width)
    return path, df.schema


def plain(old, new):
    copies = Counter(new)
    copies.subtract(old)
    rows = {r: n for r, n in copies.items() if n}
    out = []
    for r, n in rows.items():
        signs = {m > 0 for q, m in rows.items() if q[0] == r[0]}
        out.append((*r, n, "changed" if len(signs) > 1 else "added" if n > 0 else "removed"))
    return sorted(out, key=repr)


def test_random_tables_null_keys_and_repeated_rows(spark):
    rng = random.Random(2)
    for size in (0, 1, 300):
        old = [(rng.choice([None, rng.randrange(-7000, 7000)]), rng.choice([None, 1, 2]),
                rng.choice([None, "", "x"])) for _ in range(size)]
        old += old[:size // 9]
        new = [r if rng.random() < .9 else (r[0], 7, r[2]) for r in old if rng.random() < .95]
        new += [(rng.randrange(7000), 3, "y") for _ in range(size // 20)] + [(None, None, None)]
        (a, schema), (b, _) = written(spark, old), written(spark, new)
        got = S.snapshot_changes(spark, a, b, schema, "id").collect()
        assert sorted(map(tuple, got), key=repr) == plain(old, new)
        assert S.snapshot_changes(spark, b, b, schema, "id").count() == 0


def test_null_is_not_like_another_value(spark):
    rows = [(1, None, ""), (2, 0, None), (3, None, None)]
    for other in ([(1, 0, ""), *rows[1:]], [rows[0], (2, 0, ""), rows[2]], [rows[0], rows[1], (None, 3, None)]):
        (a, schema), (b, _) = written(spark, rows), written(spark, other)
        got = S.snapshot_changes(spark, a, b, schema, "id").collect()
        assert sorted(map(tuple, got), key=repr) == plain(rows, other)


def test_only_changed_ranges_are_read(spark):
    m, root = star.match(spark, SF_SMALL).coalesce(2), work_dir(spark, "snapshot-plan")
    S.write_snapshot(m, f"{root}/a", "id", 50)
    S.write_snapshot(m.where("id NOT IN (77, 1033)"), f"{root}/b", "id", 50)
    ranges = S.changed_ranges(spark, f"{root}/a", f"{root}/b")
    assert sorted(ranges) == sorted({i // 50 for i in (77, 1033)
                                     if m.where(f"id = {i}").count()}) and ranges
    out = S.snapshot_changes(spark, f"{root}/a", f"{root}/b", m.schema, "id")
    assert {r.id for r in out.collect()} <= {77, 1033}
    filters = re.findall(r"PartitionFilters: \[[^\]]*\]", plan_text(out, "extended"))
    assert filters and all(S.RANGE in f for f in filters)
    scan = S.read_rows(spark, f"{root}/a", m.schema).where(S._among(S.F.col(S.RANGE), ranges))
    folders = {r[0].split(f"{S.RANGE}=")[1].split("/")[0]
               for r in scan.select(S.F.input_file_name()).distinct().collect()}
    assert folders == {str(r) for r in ranges}
    # The tree has a root, and inner nodes over the leaves.
    assert S.read_nodes(spark, f"{root}/a", S._levels(spark, f"{root}/a")).count() == 1

"""Every registered query with an oracle gives DuckDB's rows, with the same names, on the smallest tables."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from stripweave.operators import identify
from stripweave.plans import registry
from stripweave.plans.tables import BASE

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in BASE:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return float(value) if isinstance(value, Decimal) else value


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, duck, name):
    found = registry.QUERIES[name](spark, SMALL)
    columns = sorted(found.columns)
    names = [row[0] for row in duck.execute(f"DESCRIBE {registry.ORACLES[name]}").fetchall()]
    assert sorted(names) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = Counter(tuple(map(plain, row)) for row in duck.execute(f"SELECT {quoted} FROM ({registry.ORACLES[name]})").fetchall())
    assert Counter(tuple(plain(row[c]) for c in columns) for row in found.collect()) == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_without_oracle(spark, name):
    found = registry.QUERIES[name](spark, SMALL)
    assert found.count() > 0 or name in ("review_sample",)


def test_assignment_does_not_copy_lists_to_images(spark, duck, tmp_path, monkeypatch):
    """With 20 times the parts, rows that are assigned don't grow with images times parts."""
    for name, columns in (("part", "* REPLACE (p_partkey + r * 1000 AS p_partkey)"), ("events", "*")):
        duck.execute(f"COPY (SELECT {columns} FROM {name}, range({20 if name == 'part' else 1}) AS q(r)) TO '{tmp_path}/{name}.parquet'")
    sent, assign = [], identify.assign
    monkeypatch.setattr(identify, "assign", lambda scores, expected: sent.extend((scores.count(), expected.count())) or assign(scores, expected))
    found = registry.QUERIES["assignment_total"](spark, str(tmp_path))
    with duckdb.connect() as large:
        for name in ("part", "events"):
            large.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
        want = large.execute(f"SELECT image_id, total FROM ({registry.ORACLES['assignment_total']})").fetchall()
    assert Counter((r.image_id, r.total) for r in found.collect()) == Counter(want)
    assert max(sent) < 4 * len(want)  # the list of each image has 40 parts


def test_each_photo_is_used_once(spark):
    found = registry.QUERIES["full_match_pipeline"](spark, SMALL).where("match_tier in ('direct', 'position')")
    assert found.groupBy("pair_key", "pill_bag").count().where("count > 1 and pill_bag is not null").count() == 0
    every = registry.QUERIES["full_match_pipeline"](spark, SMALL)
    assert every.groupBy("pair_key", "order_index").count().where("count > 1").count() == 0

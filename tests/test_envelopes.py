"""Scans of landed JSON: schema behaviour, scopes, layouts."""

import json
import os

import pytest

from silvermill.operators.flatten import flatten_pages, flatten_snapshots, split_by
from silvermill.sources.entities import load_entities, scope_entities
from silvermill.sources.envelopes import Scope, scan_envelopes

SCHEMA = """owner string, repo string, fetched_at string, count bigint,
data array<struct<id bigint, user struct<type string>, pull_request struct<url string>,
  reactions struct<total_count bigint, `+1` bigint>>>"""


def put(root, relative, text):
    path = os.path.join(root, relative)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text if isinstance(text, str) else json.dumps(text))


def page(*records, **more):
    return {"owner": "o", "repo": "r", "fetched_at": "2026-04-06T02:00:00Z", "count": len(records), "data": list(records), **more}


KEYED = "yyyy=2026/mm=04/dd=06/hh=02/owner=o/repo=r/"


def test_schema_behaviour(spark, folder):
    put(folder, KEYED + "a.json", page({"id": 1, "unknown": 7}, extra="x"))
    put(folder, KEYED + "b.json", page(count="three"))
    put(folder, KEYED + "c.json", "{not json")
    df = scan_envelopes(spark, folder, SCHEMA, Scope("2026-04-06"))
    assert df.columns == ["owner", "repo", "fetched_at", "count", "data"]
    assert df.count() == 3  # the corrupt file is one row of nulls
    rows = {r.fetched_at is None: r for r in df.collect() if not r.data}
    assert rows[True].data is None and rows[True]["count"] is None
    assert rows[False]["count"] is None and rows[False].data == []  # wrong type: only that field
    assert [r.id for r in flatten_pages(df, ("record.id as id",)).collect()] == [1]


def test_corrupt_text_is_kept_when_asked(spark, folder):
    put(folder, KEYED + "c.json", "{not json")
    row = scan_envelopes(spark, folder, SCHEMA, Scope("2026-04-06"), corrupt_column="_corrupt").cache().first()
    assert row["_corrupt"] == "{not json"


def test_no_rows_from_null_empty_or_missing_array(spark, folder):
    put(folder, KEYED + "a.json", page())
    put(folder, KEYED + "b.json", {"owner": "o", "repo": "r", "data": None})
    put(folder, KEYED + "c.json", {"owner": "o", "repo": "r"})
    df = scan_envelopes(spark, folder, SCHEMA)
    assert df.count() == 3
    assert flatten_pages(df, ("record.id as id",)).count() == 0


def test_presence_flag_and_split(spark, folder):
    put(folder, KEYED + "a.json", page(
        {"id": 1, "pull_request": {}, "user": {"type": "Bot"}},
        {"id": 2, "pull_request": None, "user": {"type": "User"}, "reactions": {"total_count": 3, "+1": 2}},
        {"id": 3, "user": None},
    ))
    flat = flatten_pages(
        scan_envelopes(spark, folder, SCHEMA),
        ("record.id as id", "record.pull_request is not null as is_pull", "record.user.type = 'Bot' as is_bot",
         "record.reactions.`+1` as likes"),
    )
    without, having = split_by(flat, "is_pull")
    assert [r.id for r in having.collect()] == [1]
    assert sorted(r.id for r in without.collect()) == [2, 3]
    assert {r.id: (r.is_bot, r.likes) for r in flat.collect()} == {1: (True, None), 2: (False, 2), 3: (None, None)}


def test_map_field_keeps_json_text(spark, folder):
    put(folder, "a.json", {"data": {"props": {"a": 1, "b": "x", "c": {"z": 1}}, "tags": ["t"]}})
    df = scan_envelopes(spark, folder, "data struct<props map<string,string>, tags array<string>, gone struct<x int>>")
    row = flatten_snapshots(df, ("data.props as props", "data.tags as tags", "data.gone.x as x")).first()
    assert row.props["a"] == "1" and row.props["b"] == "x" and json.loads(row.props["c"]) == {"z": 1}
    assert row.tags == ["t"] and row.x is None


def test_scope_rules():
    with pytest.raises(ValueError):
        Scope("2026-04-06", owner="o")
    with pytest.raises(ValueError):
        Scope("2026-4-40")
    with pytest.raises(ValueError):
        Scope("06.04.2026")


@pytest.mark.parametrize("layout", ["keyed", "bare"])
def test_date_and_entity_scope(spark, folder, layout):
    for owner, repo in (("o", "r"), ("o", "R"), ("007", "x y")):
        for day, hour in (("05", "23"), ("06", "00"), ("06", "23")):
            time = f"yyyy=2026/mm=04/dd={day}/hh={hour}"
            entity = f"owner={owner}/repo={repo}" if layout == "keyed" else f"{owner}/{repo}"
            path = f"{time}/{entity}/p.json" if layout == "keyed" else f"{entity}/{time}/p.json"
            put(folder, path, page({"id": int(day + hour)}, owner=owner, repo=repo))

    def ids(scope):
        df = scan_envelopes(spark, folder, SCHEMA, scope, layout)
        return sorted((r.owner, r.repo, r.id) for r in flatten_pages(df, ("owner", "repo", "record.id as id")).collect())

    assert len(ids(Scope("2026-04-06"))) == 6  # all hours of the date
    assert ids(Scope("2026-04-06", "o", "R")) == [("o", "R", 600), ("o", "R", 623)]
    assert ids(Scope("2026-04-05", "007", "x y")) == [("007", "x y", 523)]  # kept as text


def test_missing_path(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_envelopes(spark, folder, SCHEMA, Scope("2026-04-06"))
    df = scan_envelopes(spark, folder, SCHEMA, Scope("2026-04-06"), allow_missing=True)
    assert df.count() == 0 and df.columns == ["owner", "repo", "fetched_at", "count", "data"]
    bare = scan_envelopes(spark, folder, SCHEMA, Scope("2026-04-06"), "bare", allow_missing=True)
    assert bare.count() == 0


def test_endpoint_filter(spark, folder):
    schema = SCHEMA + ", endpoint string"
    put(folder, KEYED + "a.json", page({"id": 1}, endpoint="commits"))
    put(folder, KEYED + "b.json", page({"id": 2}, endpoint="issues"))
    df = scan_envelopes(spark, folder, schema, endpoint="commits")
    assert [r.id for r in flatten_pages(df, ("record.id as id",)).collect()] == [1]


def test_entity_list(spark, folder):
    put(folder, "list.json", json.dumps([{"owner": "o", "repo": "r"}, {"owner": "o", "repo": "R"}], indent=1))
    entities = load_entities(spark, folder + "/list.json")
    assert scope_entities(entities).count() == 2
    assert [tuple(r) for r in scope_entities(entities, "o", "R").collect()] == [("o", "R")]
    with pytest.raises(ValueError, match="not in the entity list"):
        scope_entities(entities, "O", "r")
    with pytest.raises(ValueError):
        scope_entities(entities, owner="o")

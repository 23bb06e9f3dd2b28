
from quarry.operators.clean import clean_messages, first_seen, flatten_company_nodes
from quarry.sources.schemas import GRAPH_DOCUMENT_SCHEMA, ITEM_FIELDS

MSGS = [
    (1, '{"city":"A","score":5,"industry":"I","companyName":"C","province":"P","item":"10","crateTime":"t","regStatus":"s"}'),
    (2, '{"city":"B","item":"11"}'),                 # missing keys -> "0"
    (3, '{"city":null,"item":"12"}'),                # JSON null present stays null
    (4, '{"city":"D", "item":'),                     # malformed
    (5, '[1,2,3]'),                                  # top-level array
    (6, '{"item":"13","regCapital":"100"}'),         # detail message
    (7, '{"item":"10","city":"again"}'),             # same item again
    (8, '{"city":"E","score":"x9","item":"14"}'),    # non-numeric score
    (9, '{"score":{"a":1}}'),                        # nested object as text; no item
]


def test_parse_defaults_and_rejects(spark):
    df = spark.createDataFrame(MSGS, "id int, value string")
    rows, bad = clean_messages(df, ITEM_FIELDS, keep=["id"])
    got = {r.id: r for r in rows.collect()}
    assert set(got) == {1, 2, 3, 6, 7, 8, 9}
    assert {r.id for r in bad.collect()} == {4, 5}
    assert got[1].score == "5" and got[1].regStatus == "s"
    assert got[2].score == "0" and got[2].province == "0" and got[2].city == "B"
    assert got[3].city is None
    assert got[9].item == "0" and got[9].score == '{"a":1}'


def test_substring_exclusion_and_typed_score(spark):
    df = spark.createDataFrame(MSGS, "id int, value string")
    rows, bad = clean_messages(df, ITEM_FIELDS, exclude="regCapital", typed={"score": "int"}, keep=["id"])
    ids = {r.id for r in rows.collect()}
    assert 6 not in ids and 8 not in ids and 9 not in ids
    assert {r.id for r in bad.collect()} == {4, 5, 8, 9}  # 9: an object is not an int
    assert dict((r.id, r.score) for r in rows.collect())[1] == 5
    assert dict((r.id, r.score) for r in rows.collect())[2] == 0


def test_first_seen_against_registry(spark):
    df = spark.createDataFrame(MSGS, "id int, value string")
    rows, _ = clean_messages(df, ITEM_FIELDS, keep=["id"])
    registry = spark.createDataFrame([("11",)], "item string")
    out = {(r.item, r.id) for r in first_seen(rows, registry, ["item"], ["id"]).collect()}
    assert out == {("10", 1), ("12", 3), ("13", 6), ("14", 8), ("0", 9)}
    # Records without an item share the default key; a flag drops them.
    out2 = {r.item for r in first_seen(rows, registry, ["item"], ["id"], reject_default="0").collect()}
    assert "0" not in out2
    empty = spark.createDataFrame([], "item string")
    assert first_seen(rows, empty, ["item"], ["id"]).count() == 6


def test_flatten_company_nodes(spark):
    docs = [
        ({"data": {"nodes": [
            {"id": 1.0, "properties": {"name": "a"}, "labels": ["Company", "X"]},
            {"id": 2.0, "properties": {"name": None}, "labels": ["Company"]},
            {"id": 3.0, "properties": {"name": "c"}, "labels": []},
            {"id": 4.0, "properties": {"name": "d"}, "labels": ["Person"]},
        ]}},),
        ({"data": {"nodes": None}},),
        ({"data": {"nodes": [{"id": 1.0, "properties": {"name": "a"}, "labels": ["Company"]}]}},),
    ]
    df = spark.createDataFrame(docs, GRAPH_DOCUMENT_SCHEMA)
    out = {(r.node_id, r.name) for r in flatten_company_nodes(df).collect()}
    assert out == {(1.0, "a"), (2.0, None)}

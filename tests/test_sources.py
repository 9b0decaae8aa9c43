import json

from statloom.sources.readers import flatten_objects, read_csv, read_json_family, union_by_name
from statloom.sources.writers import write_csv, write_json, write_parquet

FIRST = [
    {"id": 1, "credor": {"nome": "á", "fim": {"x": 1}}, "itens": [{"v": 1.0}, {"v": None}]},
    {"id": 2, "credor": {"nome": "b", "fim": {"x": 2}}, "itens": []},
]
SECOND = [{"id": 3, "extra": "só aqui", "itens": None}]


def write_family(folder):
    (folder / "Despesas 2020.json").write_text(json.dumps(FIRST, ensure_ascii=False), "utf-8")
    (folder / "Despesas 2021.json").write_text(json.dumps(SECOND, indent=1, ensure_ascii=False), "utf-8")
    (folder / "Outros.json").write_text(json.dumps({"id": 9}), "utf-8")


def test_json_family(spark, tmp_path):
    write_family(tmp_path)
    df = read_json_family(spark, str(tmp_path), "Despesas")
    assert set(df.columns) == {"id", "credor.nome", "credor.fim", "itens", "extra"}
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["credor.nome"] == "á" and rows[1]["credor.fim"]["x"] == 1
    assert rows[1]["extra"] is None and rows[3]["extra"] == "só aqui"
    assert [len(rows[1]["itens"]), rows[2]["itens"], rows[3]["itens"]] == [2, [], None]


def test_json_family_with_schema_and_single_object(spark, tmp_path):
    write_family(tmp_path)
    df = read_json_family(spark, str(tmp_path), "Outros", "id long, missing string")
    assert [tuple(r) for r in df.collect()] == [(9, None)]


def test_mixed_types_become_text(spark, tmp_path):
    (tmp_path / "m1.json").write_text('[{"id": 1}]')
    (tmp_path / "m2.json").write_text('[{"id": "2x"}]')
    df = read_json_family(spark, str(tmp_path), "m")
    assert sorted(r["id"] for r in df.collect()) == ["1", "2x"]


def test_flatten_is_one_level(frame):
    df = frame([(1, (2, (3,)))], "a int, s struct<b: int, t: struct<c: int>>")
    flat = flatten_objects(df, "_")
    assert flat.columns == ["a", "s_b", "s_t"] and flat.first()["s_t"]["c"] == 3


def test_union_by_name(frame):
    both = union_by_name(frame([(1, "x")], "a int, b string"), frame([(2.5, 3)], "c double, a int"))
    assert sorted(tuple(r) for r in both.select("a", "b", "c").collect()) == [(1, "x", None), (3, None, 2.5)]


def test_csv_round_trip(spark, frame, tmp_path):
    df = frame([(1, "a,b", 0.1), (2, None, None)], "i int, s string, d double")
    write_csv(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))
    assert text.startswith("i,s,d") and '1,"a,b",0.1' in text and "2,," in text
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "out")).collect())) == sorted(map(tuple, df.collect()))


def test_json_and_parquet_sinks(spark, frame, tmp_path):
    df = frame([(1, (None, 2.0))], "n long, s struct<a: double, b: double>")
    write_json(df, str(tmp_path / "meta"))
    text = next((tmp_path / "meta").glob("part*")).read_text()
    assert json.loads(text) == {"n": 1, "s": {"a": None, "b": 2.0}}
    write_parquet(df, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).first()["s"]["b"] == 2.0

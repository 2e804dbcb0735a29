import json

from stratum.sources import landing as ld

COLUMNS = ["id", "name", "value"]


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def rows(df):
    return sorted(((r.id, r.name, r.value, r[ld.RESCUED]) for r in df.collect()), key=str)


def test_json_by_name_with_rescue(spark, tmp_path):
    lines = [{"id": 1, "name": "é", "value": 2.5}, {"value": None, "id": "2"}, {"id": 3, "z": {"a": [1]}, "b": "x", "ID": "other"}, {}]
    put(tmp_path, "a.json", "\n".join(map(json.dumps, lines)) + "\n\n")
    put(tmp_path, "b.json", '{"id": 4, "name"\nnot json\n[1, 2]\n"text"\n')
    got = rows(ld.read_json_rescued(spark, f"{tmp_path}/*.json", COLUMNS))
    assert got == sorted([("1", "é", "2.5", None), ("2", None, None, None), ("3", None, None, '{"ID":"other","b":"x","z":"{\\"a\\":[1]}"}'), (None, None, None, None),
                          (None, None, None, '{"id": 4, "name"'), (None, None, None, "not json"), (None, None, None, "[1, 2]"), (None, None, None, '"text"')], key=str)


def test_csv_by_name_with_rescue(spark, tmp_path):
    put(tmp_path, "a.csv", "id,name,value\n1,a,x\n2,\"b, c\",y\n3,too,many,fields\n4,few\n")
    put(tmp_path, "b.csv", "value,extra,id\nv,e,5\nw,,6\n")
    put(tmp_path, "c.csv", "id,name,value\n7,g,h\n")
    put(tmp_path, "d.csv", "id,id\n8,9\n")
    put(tmp_path, "empty.csv", "id,name,value\n")
    df = ld.read_csv_rescued(spark, f"{tmp_path}/*.csv", COLUMNS)
    assert rows(df) == sorted([("1", "a", "x", None), ("2", "b, c", "y", None), (None, None, None, '{"record":"3,too,many,fields"}'), (None, None, None, '{"record":"4,few"}'),
                               ("5", None, "v", '{"extra":"e"}'), ("6", None, "w", None), ("7", "g", "h", None), ("8", None, None, None)], key=str)
    assert len({r[ld.SOURCE_FILE] for r in df.collect()}) == 4


def test_landing_twice_is_there_once(spark, tmp_path):
    put(tmp_path / "in", "a.json", '{"id": 1}\nbroken\n')
    for _ in range(2):
        ld.land_rescued(spark, f"{tmp_path}/in", f"{tmp_path}/bronze", "json", COLUMNS, "b-1")
    ld.land_rescued(spark, f"{tmp_path}/in", f"{tmp_path}/bronze", "json", COLUMNS, "b-2")
    assert spark.read.parquet(f"{tmp_path}/bronze").count() == 4

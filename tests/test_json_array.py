"""Arrays cut at their objects by many tasks, against Python's reader."""

import json
import random

import pytest

from ledger_spark.sources.files import read_monthly_expenses
from ledger_spark.sources.json_array import read_json_array


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "97b", "spark.sql.files.openCostInBytes": "1b"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def objects_of(spark, path):
    rows = read_json_array(spark, str(path)).collect()
    assert len({(r["archivo"], r["fila"]) for r in rows}) == len(rows)
    return [r["texto"] for r in sorted(rows, key=lambda r: (r["archivo"], r["fila"]))]


def random_value(pick, depth):
    kind = pick.randrange(6 if depth else 3)
    if kind < 3:
        return "".join(pick.choices(['"', "\\", "{", "}", "[", "]", ",", "ñ", "x", "\n", "}{", '\\"'], k=pick.randrange(9)))
    if kind == 3:
        return [random_value(pick, depth - 1) for _ in range(pick.randrange(4))]
    return {random_value(pick, 0): random_value(pick, depth - 1) for _ in range(pick.randrange(4))}


@pytest.mark.parametrize("indent", [None, 0, 2])
def test_any_array_in_small_blocks(spark, tmp_path, small_blocks, indent):
    pick = random.Random(indent)
    records = [{"k": random_value(pick, 3), "n": n} for n in range(120)] + [{}, {"n": "}"}]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps(records[:7], indent=indent), encoding="utf-8-sig")
    got = [json.loads(t) for t in objects_of(spark, tmp_path)]
    assert got == records + records[:7]
    read = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert read.rdd.getNumPartitions() > 20


@pytest.mark.parametrize("text", ["", "[]", "[ ]\n", "  [\n]  ", "\n"])
def test_no_objects(spark, tmp_path, small_blocks, text):
    (tmp_path / "a.json").write_text(text)
    assert objects_of(spark, tmp_path) == []


def test_ends_of_files(spark, tmp_path, small_blocks):
    cases = {
        "a": ('[{"a":1},{"a":2', ['{"a":1}', '{"a":2']),
        "b": ('[{"a":1},{"a":{"b":2}', ['{"a":1}', '{"a":{"b":2}']),
        "c": ('{"a":1}', ['{"a":1}']),
        "d": ('[{"a":1}, 7, {"a":2}]', ['{"a":1}', '7, {"a":2}']),
        "e": ('\ufeff[{"a":1},{"a":"ñ', ['{"a":1}', '{"a":"ñ']),
        "g": ('[{"a":1}]\n[ {"a":2},{"a":3} ] []\n[{"a":4}]', ['{"a":1}', '{"a":2}', '{"a":3}', '{"a":4}']),
        "f": ('[{"a":"x}"},\n {"b":"\\"}"}]', ['{"a":"x}"}', '{"b":"\\"}"}']),
    }
    for name, (text, _) in cases.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    for name, (_, want) in cases.items():
        assert objects_of(spark, tmp_path / f"{name}.json") == want, name


def test_monthly_records_as_from_one_task(spark, tmp_path, small_blocks):
    records = [
        {"_id": {"$oid": f"{n}"}, "Nombre del consorcio": f"Casa {n % 7}", "Mes": "mayo ", "LIMPIEZA": f"{n},00"}
        for n in range(80)
    ] + [{"_id": {"$oid": "x"}}]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=1))
    whole, cut = (read_monthly_expenses(spark, str(tmp_path), large=large) for large in (False, True))
    assert cut.columns == whole.columns
    key = lambda r: r["posicion"]["fila"]
    assert sorted(cut.collect(), key=key) == sorted(whole.collect(), key=key)


def test_an_unreadable_object_is_rejected_alone(spark, tmp_path, small_blocks):
    (tmp_path / "a.json").write_text('[{"Mes":"mayo"},{"Mes":},{"Mes":"junio"}]')
    rows = read_monthly_expenses(spark, str(tmp_path), large=True).collect()
    found = {r["posicion"]["fila"]: (r["periodo"], r["_corrupt_record"]) for r in rows}
    assert found == {0: ("mayo", None), 1: (None, '{"Mes":}'), 2: ("junio", None)}

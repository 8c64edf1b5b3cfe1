"""People under two spellings, against comparison of all pairs."""

import itertools
import random

from pyspark.sql import functions as F

from ledger_spark.operators.linkage import LONG, groups, one_edit_apart, plain_name
from ledger_spark.plans.respelled import people_groups, similar_people

PEOPLE = "id_persona string, dni string, nombre string, apellido string, email string"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_pairs(rows):
    """Every pair of people by the two rules of the docstring."""

    def name(row):
        text = " ".join(x for x in (row[2], row[3]) if x is not None)
        return " ".join(text.lower().split()).translate(str.maketrans("áéíóúüñ", "aeiouun"))

    people = {(r[0], r[1], name(r), (r[4] or "").strip().lower()) for r in rows if r[0] and name(r)}
    heads = {}
    for who, _, called, mail in people:
        if mail:
            heads[mail, called] = min(who, heads.get((mail, called), who))
    found = {}

    def link(a, b, rule):
        if a != b:
            found.setdefault((min(a, b), max(a, b)), set()).add(rule)

    for p, q in itertools.combinations(people, 2):
        if p[1] and q[1] and edits(p[1], q[1]) == 1 and edits(p[2], q[2]) <= 2:
            link(p[0], q[0], "doc")
        if p[3] and p[3] == q[3] and edits(p[2], q[2]) == 1:
            link(heads[p[3], p[2]], heads[q[3], q[2]], "con")
    for who, _, called, mail in people:
        if mail:
            link(who, heads[mail, called], "con")
    return {pair: ("doc" in rules, "con" in rules) for pair, rules in found.items()}


def brute_groups(pairs):
    label = {n: n for pair in pairs for n in pair}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return {n: (g, sum(n in p for p in pairs)) for n, g in label.items()}


def pairs_of(df):
    return {(r["id_a"], r["id_b"]): (r["por_documento"], r["por_contacto"]) for r in df.collect()}


def groups_of(df, key="id_persona"):
    return {r[key]: (r["grupo"], r["enlaces"]) for r in df.collect()}


def test_texts_one_edit_apart(spark):
    pick = random.Random(3)
    texts = {"", "a", "b", "ab", "ba", "abc", "ñandú", "ñandu", "aa", "aaa"}
    for size in (6, LONG - 1, LONG, LONG + 1, 90):
        for _ in range(6):
            base = "".join(pick.choices("ab", k=size))
            texts.add(base)
            for _ in range(8):
                at = pick.randrange(size)
                texts.add(base[:at] + pick.choice(["", "c", base[at] + "d"]) + base[at + 1 :])
    df = spark.createDataFrame([(t,) for t in [*texts, *texts, None]], "t string")
    got = {tuple(r) for r in one_edit_apart(df, "t").collect()}
    want = {(min(p), max(p)) for p in itertools.combinations(texts, 2) if edits(*p) == 1}
    assert got == want and len(want) > 100


def test_within_the_same_key_only(spark):
    rows = [("x", "ana"), ("x", "anna"), ("y", "ann"), (None, "an"), (None, "ana"), ("y", None)]
    got = one_edit_apart(spark.createDataFrame(rows, "k string, t string"), "t", ["k"]).collect()
    assert [tuple(r) for r in got] == [("x", "ana", "anna")]


def test_names_are_compared_without_accents_and_blanks(spark):
    df = spark.createDataFrame([(" José  María", "NÚÑEZ "), ("", " "), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(plain_name(F.col("a"), F.col("b"))).collect()]
    assert got == ["jose maria nunez", None, None]


def test_pairs_and_groups_against_all_pairs(spark):
    pick = random.Random(8)
    names = ["Ana", "Anna", "José", "Jose", "Leo", "", None]
    rows = []
    for n in range(260):
        document = "".join(pick.choices("123", k=pick.randint(3, 5)))
        row = (document, pick.choice([document, document, document, None, ""]), pick.choice(names))
        rows.append((*row, pick.choice(["Paz", "Pas", "Gómez"]), pick.choice(["a@x", " A@X", "b@x", "", None])))
    rows += rows[:20] + [(None, "123", "Ana", "Paz", "a@x")]
    df = spark.createDataFrame(rows, PEOPLE)
    want = brute_pairs(rows)
    assert pairs_of(similar_people(df)) == want and len(want) > 100
    assert groups_of(people_groups(df)) == brute_groups(want)


def test_a_shared_address_gives_one_pair_a_member(spark):
    rows = [(f"{n:09d}", f"{n * 7919:09d}", "Caja", "Postal", "info@x") for n in range(1, 3001)]
    rows.append(("zz", "zz", "Caja", "Postal", "otro@x"))
    df = spark.createDataFrame(rows, PEOPLE)
    found = similar_people(df).where("por_contacto")
    assert found.count() == 2999 and found.where("id_a <> '000000001'").count() == 0


def test_long_chains_are_one_group(spark):
    chain = [(f"{n:04d}", f"{n + 1:04d}") for n in range(400)] + [("x", "y"), ("y", "x"), ("z", "z")]
    got = groups_of(groups(spark.createDataFrame(chain, "a string, b string")), "nodo")
    assert len(got) == 403 and {got[k][0] for k in got if k < "x"} == {"0000"}
    assert got["x"] == got["y"] == ("x", 1) and got["0000"][1] == 1 and got["0007"][1] == 2


def test_no_people(spark):
    none = spark.createDataFrame([], PEOPLE)
    assert similar_people(none).collect() == [] and people_groups(none).collect() == []


def test_texts_meet_by_key_and_never_all_with_all(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("t"))
    plan = one_edit_apart(df, "t")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_only_emails_of_several_names_give_keys(spark, monkeypatch):
    looked_up = []

    def recorded(values, text, within=()):
        if text == "nombre":
            looked_up.extend(r["email"] for r in values.select("email").distinct().collect())
        return one_edit_apart(values, text, within)

    monkeypatch.setattr("ledger_spark.plans.respelled.one_edit_apart", recorded)
    people = [(str(i), str(i) * 8, "ana", f"perez{i}", f"{i}@x") for i in range(1, 6)]
    people += [("91", "777777", "eva", "diaz", "e@x"), ("92", "888888", "eva", "dias", "E@x ")]
    df = spark.createDataFrame(people, "id_persona string, dni string, nombre string, apellido string, email string")
    assert [(r["id_a"], r["id_b"]) for r in similar_people(df).collect()] == [("91", "92")]
    assert looked_up == ["e@x"]

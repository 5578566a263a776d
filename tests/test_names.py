"""Names of a long list: the index finds what the pattern finds."""

import random

import pytest
from pyspark.sql import functions as F

from tallybank.functions.predicates import contains_any, matches_names
from tallybank.operators.names import index_names, name_matches
from test_plans import plan_of

NAMES = ("Lima", "Zélia Prado", "zelia  prado", "José da Silva", "Ana", "a-b", "li ma", "x", "D'Ávila Souto", "silva", "Odete", "--", "", " \t",
         "Antônia Prado Lima Souza", "Prado-Lima", "o_o", "Brumadinho", "ß1", "Ana.", "ç")
TEXTS = ("", "Lima", "limao", "o lima-azeda", "™lima", "→lima", "日lima", "limà", "ZELIA PRADO", "xxzéliá pradoyy", "zelia → prado", "zelia 日 prado", "zelia-prado",
         "jose da silva", "jose  da silva", "josé dá silvá e filhos", "ana.", "banana", "a-b", "aa-bb", "xali mabb", "d'avila souto", "D’Ávila Souto", "o--o", "-",
         "antonia prado lima souza", "prado-lima", "umodetex", "o_o", "o_ox", "Brúmadinho", "ß1", "½lima", "ªlima", "lima½", "ĺima", "ﷺprado zelia prado", "c", "ç")


@pytest.mark.parametrize("fold", [True, False])
def test_index_finds_what_the_pattern_finds(spark, fold):
    rng = random.Random(2)
    words = [n for n in NAMES if n.strip()] + ["de", "e", "  ", "ltda", "é"]
    texts = [*TEXTS, None, *("".join(rng.choice(words) + rng.choice(("", " ", "-", ". ", "x")) for _ in range(4)) for _ in range(300))]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    names = spark.createDataFrame([(n,) for n in (*NAMES, None, "Lima")], "n string")
    got = {tuple(r) for r in name_matches(frame, "t", names, "n", fold).collect()}
    flags = [(matches_names(F.col("t"), [n]) if fold else contains_any(F.col("t"), [n])).alias(f"c{i}") for i, n in enumerate(NAMES)]
    want = {(r["t"], NAMES[i]) for r in frame.where("t IS NOT NULL").select("t", *flags).collect() for i in range(len(NAMES)) if r[f"c{i}"]}
    assert got == want and len(want) > 300


def test_part_of_a_name_is_its_rarest(spark):
    names = spark.createDataFrame([(f"Silva Souza{i:06d}",) for i in range(50)] + [("Silva Abc",)], "name string")
    parts = {r["name"]: r["part"] for r in index_names(names).collect()}
    assert parts["Silva Abc"] == "q33:lva|abc" and len(set(parts.values())) == 51


def test_plan_does_not_grow_with_the_list(spark):
    texts = spark.range(10).select(F.lit("Pagto Ana Lima 5").alias("t"))
    sizes = []
    for n in (10, 100_000):
        found = name_matches(texts, "t", spark.range(n).select(F.concat(F.lit("Ana Lima "), F.col("id").cast("string")).alias("name")))
        sizes.append(len(plan_of(found)))
        assert {r["name"] for r in found.collect()} == {"Ana Lima 5"}
    assert abs(sizes[0] - sizes[1]) < 2000  # the kinds of parts in use differ

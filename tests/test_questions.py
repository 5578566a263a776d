"""Exam pages, question tables, attempts and booklets on small literal input."""

import pytest
from pyspark.sql import functions as F

from tallybank.operators import pages as P
from tallybank.operators import questions as Q
from tallybank.operators import study as S

OPTION = ('<label class="q-radio-button{css}"><input type="radio" value="{x}"{more}><div class="q-item-enum"> {t} '
          "</div></label>")


def option(x, t, css="", more=""):
    return OPTION.format(x=x, t=t, css=css, more=more)


ITEM = """<div class="js-question-item"><div class="js-question" data-question-id="{qid}">
<span class="q-index"> {idx} </span><div class="q-question-enunciation"> Um <b>texto</b> &amp; mais </div>
<div class="q-question-info"><span>Ano: 2024</span><span>Banca: <a>FG</a></span><span>Prova: <a>P1</a></span></div>
<div class="q-question-breadcrumb"><a>Direito</a></div>
<div class="q-question-options">{options}</div>{extra}</div></div>"""
KEY = ('<fieldset class="q-questions-feedback"><div class="q-feedback"><span class="q-index">1:</span>'
       '<span class="q-answer">C</span></div></fieldset>')
NOTEBOOK_PAGE = "<html><script>var a='<div class=\"js-question-item\">'</script>" + ITEM.format(
    qid=10, idx=1, options=option("A", "x") + option("A", "last"), extra="") + ITEM.format(
    qid=11, idx=2, options=option("B", "y"), extra='<span class="js-question-right-answer"> B </span>') + ITEM.format(
    qid=12, idx=3, options=option("D", "z", " q-correct"), extra="") + ITEM.format(
    qid=13, idx=4, options="", extra="<br><p>open") + KEY
MOCK_PAGE = """<div class="q-answer-sheet-question"><span class="q-resumed-statement"><b>7</b>. Curto</span>
<span class="q-incorrect">Errada</span><div class="q-answer">Você marcou a resposta A, mas a alternativa correta é
C.</div><ul class="q-question-options">{o}</ul><div class="q-text"><p>um</p><p>dois</p></div></div>
<div class="q-answer-sheet-question"><span class="q-correct">Certa</span>
<div class="q-question-enunciation">Longo</div><ul class="q-question-options">{c}</ul></div>""".format(
    o=option("C", "Certo") + option("E", "Errado"), c=option("B", "b", more=" checked"))


def read(spark, *htmls):
    return P.read_pages(spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string"))


def test_notebook_page(spark):
    rows = P.extract_questions(read(spark, NOTEBOOK_PAGE, "<p>nothing</p>", "")).orderBy("pos").collect()
    assert [r["ID_Questao"] for r in rows] == ["Q10", "Q11", "Q12", "Q13"]
    assert [r["Resposta_Correta"] for r in rows] == ["C", "B", "D", None]
    first = rows[0]
    assert first["Enunciado"] == "Umtexto& mais" and first["Ano"] == "2024" and first["Banca"] == "FG"
    assert first["Orgao"] is None and first["Disciplina"] == "Direito" and first["Assunto"] is None
    wide = Q.export_questions(Q.widen_options(P.extract_questions(read(spark, NOTEBOOK_PAGE)))).orderBy("ID_Questao")
    row = wide.first()
    assert row["Alternativa_A"] == "last" and row["Alternativa_E"] == "" and row["Orgao"] == "N/A"


def test_answer_key_keeps_the_last_entry(spark):
    page = ITEM.format(qid=1, idx=1, options="", extra="") + KEY.replace("</fieldset>", "") + (
        '<div class="q-feedback"><span class="q-index">1:</span><span class="q-answer">E</span></div></fieldset>')
    assert P.extract_answer_key(read(spark, page)).head()["answer"] == "E"
    assert P.extract_questions(read(spark, page)).head()["Resposta_Correta"] == "E"


def test_mock_page(spark):
    first, second = P.extract_mock_exam(read(spark, MOCK_PAGE)).orderBy("pos").collect()
    assert (first["Numero_Questao"], first["Resultado"], first["Enunciado"]) == ("7", "Errada", "Curto") or \
        first["Enunciado"] == ". Curto"
    assert (first["Resposta_Marcada"], first["Resposta_Correta"]) == ("A", "C")
    assert first["Comentario_Professor"] == "um\ndois"
    assert [(o["letter"], o["text"]) for o in first["options"]] == [("Certo", "Certo"), ("Errado", "Errado")]
    assert (second["Resultado"], second["Enunciado"], second["Resposta_Correta"]) == ("Certa", "Longo", "B")


def test_unreadable_pages_are_reported(spark, monkeypatch):
    def broken(self, data):
        raise RuntimeError("bad page")
    monkeypatch.setattr(P._Tree, "feed", broken)
    page = P.read_page(NOTEBOOK_PAGE)
    assert page["questions"] == [] and page["problems"] == [{"part": "page", "pos": None, "message": "RuntimeError: bad page"}]


def test_one_bad_item_costs_only_itself(spark, monkeypatch):
    read = P._question

    def picky(item):
        if (item.find("span", "q-index") or item).text() == "2":
            raise KeyError("odd")
        return read(item)
    monkeypatch.setattr(P, "_question", picky)
    page = P.read_page(NOTEBOOK_PAGE)
    assert [q["idx"] for q in page["questions"]] == ["1", "3", "4"] and page["answers"][0]["answer"] == "C"
    assert page["problems"] == [{"part": "question", "pos": 1, "message": "KeyError: 'odd'"}]


def test_mock_links_default_patterns(spark):
    html = ('<a href="/simulados/1">Um</a><a class="x" href="/provas/2"> </a><a href="/simulados/1">again</a>'
            '<a href="/outro">no</a><a href="/meu-simulado?a=1&amp;b=2"><b>S</b></a>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [(r["href"], r["priority"], r["name"]) for r in P.mock_links(pages).orderBy("priority", "pos").collect()]
    assert got == [("/simulados/1", 1, "Um"), ("/provas/2", 2, "/provas/2"), ("/meu-simulado?a=1&b=2", 4, "S")]


def test_chi_square(spark):
    even = spark.createDataFrame([(x,) for x in "ABCDE" * 10], "a string")
    assert tuple(Q.chi_square(even, "a").head()) == (10.0, 0.0, True)
    only = spark.createDataFrame([("A",)] * 50, "a string")
    assert tuple(Q.chi_square(only, "a").head()) == (10.0, 160.0, False)
    assert tuple(Q.chi_square(only, "a", Q.LETTERS).head()) == (10.0, 200.0, False)


def test_best_attempt(spark):
    data = [("a", 1, 50), ("a", 2, 70), ("b", 1, 66), ("b", 2, 90), ("c", 1, 50), ("c", 2, 40), ("d", 1, 0)]
    frame = spark.createDataFrame(data, "k string, attempt int, score int")
    got = {r["k"]: (r["attempt"], r["score"]) for r in S.best_attempt(frame, "k", 65).collect()}
    assert got == {"a": (2, 70), "b": (1, 66), "c": (2, 40), "d": (1, 0)}


def test_content_key_treats_null_as_empty(spark):
    frame = spark.createDataFrame([("a", "b", None), ("a", "b", "")], "x string, y string, z string")
    assert frame.select(Q.content_key("x", "y", "z").alias("k")).distinct().count() == 1


def test_booklets_are_cut_into_volumes(spark):
    frame = spark.range(1, 451).select(F.lit("k").alias("booklet"), F.col("id").alias("number"),
                                       F.col("id").cast("string").alias("fragment"))
    got = {r["volume"]: (r["questions"], r["body"].split("\n")[0]) for r in S.booklet(frame, "booklet", volume_size=200).collect()}
    assert got == {1: (200, "1"), 2: (200, "201"), 3: (50, "401")}
    with pytest.raises(Exception, match="question number 7 of booklet k is not unique"):
        S.booklet(frame.withColumn("number", F.lit(7)), "booklet", volume_size=200).collect()


def test_pick_and_wrong(spark):
    frame = spark.createDataFrame([(1, "Errada"), (2, "certa"), (3, "FALSE"), (4, None)], "n int, Resultado string")
    assert [r["n"] for r in Q.wrong_answers(frame).collect()] == [1, 3]
    assert [r["n"] for r in Q.pick_items(frame, "n", "2, 9,4").collect()] == [2, 4]
    assert Q.pick_items(frame, "n", " todos ").count() == 4


def test_report_and_seconds(spark):
    frame = spark.sql("SELECT timestamp'2025-01-01 00:00:00' s, timestamp'2025-01-01 00:00:10' e UNION ALL "
                      "SELECT timestamp'2025-01-01 00:00:10', timestamp'2025-01-01 00:00:30'")
    assert tuple(S.mean_seconds(frame, "s", "e").head()) == (30.0, 15.0)
    text = spark.range(1).select(S.text_report(*[F.lit(x) for x in "abc"], F.lit(None), F.lit("s")).alias("t")).head()[0]
    assert "ENUNCIADO\na" in text and "PROFESSOR\nN/A" in text

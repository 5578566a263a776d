"""Views that give the given tables the shapes of a ledger, a trial balance and a question bank.

Each view exists twice: as DataFrame code, and as SQL text for checking results in another engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybank.functions.text import html_escape
from tallybank.session import INPUT_PARTITIONS

LETTER_LIST = "ABCDE"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(frame: DataFrame, columns) -> DataFrame:
    """Only these columns. A job over one small file may ask, by a setting of its session, for its rows to be dealt out."""
    frame = frame.select(*columns)
    parts = frame.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return frame.repartition(int(parts)) if parts else frame


#: Parts that a table is dealt into, at least, when every row of it becomes a page.
PAGE_PARTS = 64


def dealt(frame: DataFrame) -> DataFrame:
    """The rows of a narrow table in many parts. A page is hundreds of times the row it is made from, so the few tasks that
    the size of the file asks for would read all pages."""
    spark = frame.sparkSession
    return frame if spark.conf.get(INPUT_PARTITIONS, None) else frame.repartition(max(PAGE_PARTS, 4 * spark.sparkContext.defaultParallelism))


def _amount_text(amount: Column) -> Column:
    return F.replace(amount.cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))


# --- ledger ----------------------------------------------------------------------------------


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journal lines as text: mixed date layouts, garbage dates, blanks, repeated postings."""
    lines = spread(table(spark, sf_dir, "lineitem"), (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag"))
    orders, parts = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    rows = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey")))
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    # Cut from the text form, so that no time zone takes part.
    stamp = F.col("o_orderdate").cast("string")
    day = F.substring(stamp, 1, 10)
    day_first = F.concat_ws("/", F.substring(stamp, 9, 2), F.substring(stamp, 6, 2), F.substring(stamp, 1, 4))
    copies = F.filter(F.array(*[F.lit(i) for i in (1, 2, 3, 4)]),
                      lambda k: (k == 1) | ((k < 4) & (order % 50 == 0)) | ((k == 4) & (day == "1996-12-31")))
    price = F.col("l_extendedprice")
    returned = F.col("l_returnflag") == "R"
    movement = (F.when(returned, -1).otherwise(1)
                * F.when(part % 25 == 0, (F.floor(price / 10) * 10).cast("double")).otherwise(price))
    word = F.element_at(F.array(*[F.lit(w) for w in (
        "Pedido", "AJUSTE", "Reversão", "outros", "Variação Cambial", "conforme", "pagto Zélia Prado", "nf")]),
        (part % 8 + 1).cast("int"))
    return rows.withColumn("k", F.explode(copies)).select(
        F.when(F.col("k") == 4, "15/01/1997")
        .when(order % 97 == 0, None)
        .when(order % 89 == 0, "Conta:")
        .when(order % 10 == 0, day)
        .otherwise(day_first).alias("DATA"),
        F.concat(F.lit("1."), F.lpad((F.col("o_custkey") % 50).cast("string"), 5, "0")).alias("CONTA"),
        F.when(F.col("l_linenumber") != 7,
               F.concat(F.lit("1-"), F.lpad((F.col("l_suppkey") % 60).cast("string"), 5, "0"))
               ).alias("CONTRAPARTIDA"),
        _amount_text(movement).alias("MOVIMENTO"),
        F.when(~returned, _amount_text(price)).alias("DEBITO"),
        F.when(returned, _amount_text(price)).alias("CREDITO"),
        F.when(~((F.col("l_linenumber") == 1) & (order % 13 == 0)),
               F.concat_ws(" ", word, F.col("p_name"))).alias("HISTORICO"),
    )


LEDGER_SQL = """
SELECT
  CASE WHEN k = 4 THEN '15/01/1997'
       WHEN l_orderkey % 97 = 0 THEN NULL
       WHEN l_orderkey % 89 = 0 THEN 'Conta:'
       WHEN l_orderkey % 10 = 0 THEN substr(CAST(o_orderdate AS VARCHAR), 1, 10)
       ELSE concat(substr(CAST(o_orderdate AS VARCHAR), 9, 2), '/',
                   substr(CAST(o_orderdate AS VARCHAR), 6, 2), '/',
                   substr(CAST(o_orderdate AS VARCHAR), 1, 4)) END AS DATA,
  concat('1.', lpad(CAST(o_custkey % 50 AS VARCHAR), 5, '0')) AS CONTA,
  CASE WHEN l_linenumber = 7 THEN NULL
       ELSE concat('1-', lpad(CAST(l_suppkey % 60 AS VARCHAR), 5, '0')) END AS CONTRAPARTIDA,
  replace(CAST(CAST(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END
       * CASE WHEN l_partkey % 25 = 0 THEN floor(l_extendedprice / 10) * 10
              ELSE l_extendedprice END AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS MOVIMENTO,
  CASE WHEN l_returnflag <> 'R'
       THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') END AS DEBITO,
  CASE WHEN l_returnflag = 'R'
       THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') END AS CREDITO,
  CASE WHEN l_linenumber = 1 AND l_orderkey % 13 = 0 THEN NULL
       ELSE concat(CASE l_partkey % 8 WHEN 0 THEN 'Pedido' WHEN 1 THEN 'AJUSTE' WHEN 2 THEN 'Reversão'
                   WHEN 3 THEN 'outros' WHEN 4 THEN 'Variação Cambial' WHEN 5 THEN 'conforme'
                   WHEN 6 THEN 'pagto Zélia Prado' ELSE 'nf' END, ' ', p_name) END AS HISTORICO
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN (SELECT 1 AS k UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) rep
    ON k = 1 OR (k < 4 AND l_orderkey % 50 = 0)
       OR (k = 4 AND substr(CAST(o_orderdate AS VARCHAR), 1, 10) = '1996-12-31')
"""

GROUPS = ("Imobilizado", "Receita bruta", "Receitas financeiras", "Caixa e equivalentes de caixa",
          "Fornecedores", "Contas a receber")
KINDS = ("Ativo", "Passivo", "PL", "Resultado")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trial balance with repeated accounts; accounts ending in 00 to 02 are not in it."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("ORD"),
        F.concat(F.lit("1"), F.lpad((3 + key % 52).cast("string"), 5, "0")).alias("CONTA"),
        _pick(GROUPS, key % 6).alias("GRUPO"),
        _pick(KINDS, key % 4).alias("CTP"),
    )


BALANCE_SQL = """
SELECT c_custkey AS ORD,
  concat('1', lpad(CAST(3 + c_custkey % 52 AS VARCHAR), 5, '0')) AS CONTA,
  CASE c_custkey % 6 WHEN 0 THEN 'Imobilizado' WHEN 1 THEN 'Receita bruta' WHEN 2 THEN 'Receitas financeiras'
       WHEN 3 THEN 'Caixa e equivalentes de caixa' WHEN 4 THEN 'Fornecedores' ELSE 'Contas a receber' END AS GRUPO,
  CASE c_custkey % 4 WHEN 0 THEN 'Ativo' WHEN 1 THEN 'Passivo' WHEN 2 THEN 'PL' ELSE 'Resultado' END AS CTP
FROM customer
"""


def party_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text per order that tells its customer's name, in one of three spellings, and the order's priority."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    name, order = F.col("c_name"), F.col("o_orderkey")
    told = F.when(order % 3 == 0, F.upper(name)).when(order % 3 == 1, F.replace(name, F.lit("o"), F.lit("ó"))).otherwise(name)
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.concat(F.lit("Pagto "), told, F.lit("/"), F.col("o_orderpriority")).alias("HISTORICO"))


PARTY_SQL = """
SELECT o_orderkey, concat('Pagto ', CASE o_orderkey % 3 WHEN 0 THEN upper(c_name) WHEN 1 THEN replace(c_name, 'o', 'ó') ELSE c_name END,
  '/', o_orderpriority) AS HISTORICO
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def watch_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A watch list from the customers: names of one segment with their accents, some cut to what other names hold too."""
    key, name = F.col("c_custkey"), F.col("c_name")
    return table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.when(key % 20 == 0, F.substring(name, 1, 17)).when(key % 2 == 0, F.replace(name, F.lit("u"), F.lit("ú"))).otherwise(name).alias("name"))


WATCH_SQL = """
SELECT CASE WHEN c_custkey % 20 = 0 THEN substr(c_name, 1, 17) WHEN c_custkey % 2 = 0 THEN replace(c_name, 'u', 'ú') ELSE c_name END AS name
FROM customer WHERE c_mktsegment = 'BUILDING'
"""


# --- question bank ---------------------------------------------------------------------------


def letter_at(index: Column) -> Column:
    return F.substring(F.lit(LETTER_LIST), (index % 5 + 1).cast("int"), F.lit(1))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a question bank."""
    doc, text = F.col("doc_id"), F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("Q"), doc.cast("string")).alias("ID_Questao"),
        (2015 + doc % 10).alias("Ano"),
        F.col("lang").alias("Banca"),
        F.col("source").alias("Orgao"),
        F.concat(F.lit("T"), (doc % 17).cast("string")).alias("Assunto"),
        text.alias("Enunciado"),
        F.when(doc % 23 == 0, "N/A").otherwise(letter_at(F.ascii(text))).alias("Resposta_Correta"),
        F.when(doc % 3 == 0, "Certa").when(doc % 3 == 1, "Errada").alias("Resultado"),
        F.when(doc % 7 == 0, None).when(doc % 7 == 1, "nan").otherwise(text).alias("Comentario_Professor"),
        F.concat(F.lit("opção "), letter_at(doc)).alias("Alternativa_A"),
        F.when(doc % 11 != 0, F.col("source")).alias("Alternativa_B"),
    )


QUESTIONS_SQL = """
SELECT doc_id, concat('Q', doc_id) AS ID_Questao, 2015 + doc_id % 10 AS Ano, lang AS Banca, source AS Orgao,
  concat('T', doc_id % 17) AS Assunto, text AS Enunciado,
  CASE WHEN doc_id % 23 = 0 THEN 'N/A'
       ELSE substr('ABCDE', CAST(1 + ascii(text) % 5 AS BIGINT), 1) END AS Resposta_Correta,
  CASE WHEN doc_id % 3 = 0 THEN 'Certa' WHEN doc_id % 3 = 1 THEN 'Errada' END AS Resultado,
  CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN 'nan' ELSE text END AS Comentario_Professor,
  concat('opção ', substr('ABCDE', 1 + doc_id % 5, 1)) AS Alternativa_A,
  CASE WHEN doc_id % 11 <> 0 THEN source END AS Alternativa_B
FROM documents
"""


def analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with rubric marks in front, as generated explanations."""
    doc = F.col("doc_id")
    marks = F.concat(
        F.when(doc % 4 == 0, "IDENTIFICAÇÃO CONCEITOS GABARITO ").when(doc % 4 == 1, "1️⃣ 2️⃣ gabarito: ")
        .otherwise(""),
        F.when(doc % 2 == 0, "Alternativa A ✅ alternativa b ❌ ALTERNATIVA C ❌ ").otherwise("A: B: ✅ "),
        F.when(doc % 3 == 0, "ALTERNATIVA D ❌ ALTERNATIVA E ❌ ✅ pegadinha ").otherwise(""),
        F.when(doc % 5 == 0, "art. 5 da constituição, princípio ")
        .when(doc % 5 == 1, "regra gramatical, sintaxe, concordância ")
        .when(doc % 5 == 2, "TEMA: EXPLICAÇÃO OBJETIVA: ")
        .when(doc % 5 == 3, "RESUMO PARA MEMORIZAÇÃO: MOTIVO DA RESPOSTA CORRETA: ")
        .otherwise("⚠️ erro "),
    )
    docs = spread(table(spark, sf_dir, "documents"), ("doc_id", "lang", "source", "text"))
    return docs.select("doc_id", "lang", "source", F.concat(marks, F.col("text")).alias("text"))


ANALYSES_SQL = """
SELECT doc_id, lang, source, concat(
  CASE doc_id % 4 WHEN 0 THEN 'IDENTIFICAÇÃO CONCEITOS GABARITO ' WHEN 1 THEN '1️⃣ 2️⃣ gabarito: ' ELSE '' END,
  CASE WHEN doc_id % 2 = 0 THEN 'Alternativa A ✅ alternativa b ❌ ALTERNATIVA C ❌ ' ELSE 'A: B: ✅ ' END,
  CASE WHEN doc_id % 3 = 0 THEN 'ALTERNATIVA D ❌ ALTERNATIVA E ❌ ✅ pegadinha ' ELSE '' END,
  CASE doc_id % 5 WHEN 0 THEN 'art. 5 da constituição, princípio '
                  WHEN 1 THEN 'regra gramatical, sintaxe, concordância '
                  WHEN 2 THEN 'TEMA: EXPLICAÇÃO OBJETIVA: '
                  WHEN 3 THEN 'RESUMO PARA MEMORIZAÇÃO: MOTIVO DA RESPOSTA CORRETA: '
                  ELSE '⚠️ erro ' END,
  text) AS text
FROM documents
"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two attempts per document: the bare text, then the text with rubric marks. Some bare ones failed."""
    bare = spread(table(spark, sf_dir, "documents"), ("doc_id", "text")).select(
        "doc_id", F.lit(1).alias("attempt"),
        F.when(F.col("doc_id") % 19 == 0, F.concat(F.lit("❌ Erro: "), F.col("text")))
        .otherwise(F.col("text")).alias("text"))
    marked = analyses(spark, sf_dir).select("doc_id", F.lit(2).alias("attempt"), "text")
    return bare.unionByName(marked)


ATTEMPTS_SQL = f"""
SELECT doc_id, 1 AS attempt,
  CASE WHEN doc_id % 19 = 0 THEN concat('❌ Erro: ', text) ELSE text END AS text FROM documents
UNION ALL SELECT doc_id, 2 AS attempt, text FROM ({ANALYSES_SQL}) marked
"""


def question_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exam page per document, with two questions, options, an answer key, and the given page around it."""
    doc = F.col("doc_id")
    answer = letter_at(doc)

    def option(letter):
        css = F.when((doc % 3 == 2) & (answer == letter), "q-radio-button q-correct").otherwise("q-radio-button")
        return F.concat(F.lit('<label class="'), css, F.lit(f'"><input type="radio" value="{letter}">'
                        f'<div class="q-item-enum"> opção {letter} '), doc.cast("string"), F.lit("</div></label>"))

    def item(number, statement, extra):
        return F.concat(
            F.lit('<div class="js-question-item"><div class="js-question" data-question-id="'),
            doc.cast("string"), F.lit(f'-{number}"><span class="q-index">{number}</span>'),
            F.lit('<div class="q-question-info"><span>Ano: '), (2015 + doc % 10).cast("string"),
            F.lit("</span><span>Banca: <a>"), F.col("lang"), F.lit("</a></span><span>Órgão: <a>"),
            F.col("source"), F.lit('</a></span></div><div class="q-question-breadcrumb"><a>Direito</a><a>T'),
            (doc % 17).cast("string"), F.lit('</a></div><div class="q-question-enunciation">'), statement,
            F.lit('</div><div class="q-question-options">'), *[option(x) for x in LETTER_LIST],
            F.lit("</div>"), extra, F.lit("</div></div>"))

    own = F.when(doc % 3 == 1, F.concat(F.lit('<span class="js-question-right-answer"> '), answer,
                                        F.lit(" </span>"))).otherwise("")
    key = F.concat(
        F.lit('<fieldset class="q-questions-feedback"><div class="q-feedback"><span class="q-index">1:</span>'
              '<span class="q-answer">'), F.when(doc % 3 == 0, answer).otherwise("N/A"),
        F.lit("</span></div></fieldset>"))
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><style>p{margin:0}</style></head><body>"),
        item(1, html_escape(F.col("text")), own), item(2, F.col("lang"), F.lit("")), key,
        F.lit("</body></html>"))
    return (spread(table(spark, sf_dir, "documents"), ("doc_id", "text", "lang", "source"))
            .select(doc.alias("page_id"), html.alias("html")))


def mock_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answered mock-exam question per conversation turn.

    Every fifth has no sentence but a checked radio outside its options; every seventh is a true-or-false question,
    the others have three options.
    """
    conv, turn = F.col("conv_id"), F.col("turn")
    kind, silent = (conv + turn) % 7, (conv + turn) % 5 == 4

    def option(letter, words):
        return F.concat(F.lit(f'<label class="q-radio-button"><input type="radio" value="{letter}">'
                              '<div class="q-item-enum"> '), words, F.lit(" </div></label>"))

    three = F.concat(*[option(x, F.concat(F.lit(f"opção <b>{x}</b> "), F.col("role"))) for x in "ABD"])
    options = F.concat(F.lit('<ul class="q-question-options">'), F.when(
        kind == 6, F.concat(option("C", F.lit("Certo")), option("E", F.lit("Errado")))).otherwise(three), F.lit("</ul>"))
    checked = F.when(silent, F.lit('<p><input type="radio" value="B" checked></p>')).otherwise("")
    right = (conv + turn) % 3 == 0
    chosen, correct = letter_at(conv), letter_at(conv + turn + 1)
    text = html_escape(F.col("text"))
    html = F.concat(
        F.lit('<div class="q-answer-sheet-question"><span class="q-resumed-statement">'),
        (turn + 1).cast("string"), F.lit(". "), text, F.lit("</span>"),
        F.when(right, '<span class="q-correct">Certa</span>').otherwise('<span class="q-incorrect">Errada</span>'),
        F.when(F.col("role") == "user", F.concat(F.lit('<div class="q-question-enunciation">'), text,
                                                 F.lit("</div>"))).otherwise(""),
        F.lit('<div class="q-answer">'),
        F.when(silent, F.lit("")).when(right, F.concat(F.lit("Correto! Você marcou a resposta <b>"), chosen, F.lit("</b>.")))
        .otherwise(F.concat(F.lit("Você marcou a resposta <b>"), chosen,
                            F.lit("</b>, mas a alternativa correta é <b>"), correct, F.lit("</b>."))),
        F.lit("</div>"), options, checked,
        F.lit('<div class="q-text"><p>'), F.col("role"), F.lit("</p><p>"), text, F.lit("</p></div></div>"))
    return table(spark, sf_dir, "conversations").select(
        (conv * 100000 + turn).alias("page_id"), html.alias("html"))


def broken_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exam page per customer with two questions; of every third the first holds a number that can't be decoded in
    an attribute, so its page is read up to there."""
    key = F.col("c_custkey").cast("string")
    bad = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('<b title="&#'), F.repeat(F.lit("9"), F.lit(5000)),
                                                       F.lit(';">x</b>'))).otherwise("")

    def item(number):
        return F.concat(F.lit('<div class="js-question-item"><div class="js-question" data-question-id="'), key,
                        F.lit(f'-{number}"><span class="q-index">{number}</span></div></div>'))

    html = F.concat(item(1), F.lit("&#"), F.repeat(F.lit("9"), F.lit(5000)), F.lit(";"), bad, item(2))
    return dealt(table(spark, sf_dir, "customer").select("c_custkey")).select(F.col("c_custkey").alias("page_id"), html.alias("html"))


def link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per customer with links in every dress: quotes of both kinds and none, a misleading attribute before the
    address, entities, capitals, a repeated address, one without text and one that fits no pattern."""
    key = F.col("c_custkey").cast("string")
    html = F.concat(
        F.lit("<html><a href='/simulados/"), key, F.lit("'>T&amp;r&ecirc;s</a><A HREF=/provas/"), key,
        F.lit('><i> </i></A><p><a data-href="/provas/0" href="/practice-tests/?a='), key,
        F.lit('&amp;b=2"> <b>'), F.col("c_mktsegment"), F.lit("</b>\n</a><a href=\"/simulados/"), key,
        F.lit('">again</a><a href="/outro">no</a><a name="simulado">none</a><a href="/meu-simulado">S</a></html>'))
    return dealt(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")).select(F.col("c_custkey").alias("page_id"), html.alias("html"))


def notebook_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page of notebooks per customer: its own in a card, that of its nation beside it in the same card, and one
    outside a card. Of every other page the card has a further class."""
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")

    def link(number, name, quote):
        return F.concat(F.lit(f"<a class=q-link href={quote}/questoes-de-concursos/questoes?notebook_ids%5B%5D="), number,
                        F.lit(f"{quote}> <b>"), name, F.lit("</b></a>"))

    html = F.concat(
        F.lit('<html><body><div class="q-content'), F.when(F.col("c_custkey") % 2 == 0, " big").otherwise(""), F.lit('">'),
        link(F.concat(F.lit("1"), key), F.col("c_name"), '"'), link(F.concat(F.lit("90"), nation), F.col("c_mktsegment"), "'"),
        F.lit('<div class="q-subtitle"> Caderno com '), key, F.lit(" questões</div></div>"),
        link(F.concat(F.lit("7"), key), F.lit("Solto &amp; livre"), ""), F.lit("</body></html>"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return dealt(customers).select(F.col("c_custkey").alias("page_id"), html.alias("html"))


CHAINS = 37


def chained_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per customer with one to three questions, in notebooks that lead from page to page. The last pages hold a
    disabled link, a link to no page, one back to the first page, one into the next notebook, or none."""
    key, chain = F.col("c_custkey"), F.col("c_custkey") % CHAINS

    def address(number):
        return F.concat(F.lit("/cadernos/"), F.lpad(number.cast("string"), 12, "0"))

    customers = table(spark, sf_dir, "customer").select("c_custkey")
    following = customers.select((key - CHAINS).alias("c_custkey"), F.lit(True).alias("more"))
    item = F.concat(F.lit('<div class="js-question-item"><div class="js-question" data-question-id="'), key.cast("string"),
                    F.lit('"><span class="q-index">1</span></div></div>'))
    turn = (F.when(F.col("more"), F.concat(F.lit("<a rel='next' href='"), address(key + CHAINS), F.lit("#top'>")))
            .when(chain % 5 == 0, F.concat(F.lit('<a class="page-next" href="https://q.example'), address(chain), F.lit('">')))
            .when(chain % 5 == 1, F.lit('<a rel=next href="?page=none">'))
            .when(chain % 5 == 2, F.concat(F.lit('<a class="next" href="'), address(chain + 1 + CHAINS), F.lit('">')))
            .when(chain % 5 == 3, F.lit('<a rel="next" class="next disabled" href="/cadernos/1">')).otherwise(F.lit("<a href=/outro>")))
    html = F.concat(F.lit("<html><a href=/inicio>Início</a>"), F.repeat(item, (key % 3 + 1).cast("int")), turn, F.lit("Próxima</a></html>"))
    return dealt(customers.join(following, "c_custkey", "left")).select(
        key.alias("page_id"), F.concat(F.lit("https://q.example"), address(key)).alias("url"), html.alias("html"))

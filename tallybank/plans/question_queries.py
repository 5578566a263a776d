"""Queries over the question bank: pages, records, profiles, scores, attempts and booklets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybank.functions.text import html_escape, normalize_answer, profile_answer, safe_file_name, slug
from tallybank.operators import pages as P
from tallybank.operators import questions as Q
from tallybank.operators import scoring as R
from tallybank.operators import study as S
from tallybank.operators.page_order import next_links, number_questions, order_pages
from tallybank.plans.adapters import (
    ANALYSES_SQL, ATTEMPTS_SQL, CHAINS, LETTER_LIST, QUESTIONS_SQL, analyses, attempts, broken_pages, chained_pages, letter_at, link_pages,
    mock_pages, notebook_pages, question_pages, questions, table)
from tallybank.plans.registry import query
from tallybank.sources.cache import KeyedCache, cache_hits, cache_misses
from tallybank.sources.staging import staging_folder

QUESTIONS = f"WITH questions AS ({QUESTIONS_SQL})"
ANALYSES = f"WITH analyses AS ({ANALYSES_SQL})"


def _sql_letter(index):
    return f"substr('ABCDE', CAST(1 + ({index}) % 5 AS BIGINT), 1)"


# --- pages -----------------------------------------------------------------------------------


@query("pages_scan", """SELECT page_id, url, length(html) AS chars,
  regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS title FROM pages""")
def pages_scan(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", F.length("html").cast("long").alias("chars"),
                                            F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("title"))


LINK_PATTERNS = ("/the", "http", "tion", "/")


# The given pages write every link as <a href="...">word</a> without tags inside, so splitting at the opening finds them.
ANCHORS_SQL = """WITH parts AS (
  SELECT page_id, string_split(html, '<a href="')[2:] AS p FROM pages),
anchors AS (SELECT page_id, unnest(list_transform(p, lambda x, i: struct_pack(pos := CAST(i - 1 AS BIGINT),
    href := replace(split_part(x, '"', 1), '&amp;', '&'),
    name := replace(trim(split_part(split_part(x, '>', 2), '<', 1)), '&amp;', '&')))) AS a FROM parts)"""


@query("page_links", ANCHORS_SQL + """, links AS (
  SELECT page_id, a.href AS href, a.pos AS pos, coalesce(nullif(a.name, ''), a.href) AS name,
    CASE WHEN contains(a.href, '/the') THEN 1 WHEN contains(a.href, 'http') THEN 2
         WHEN contains(a.href, 'tion') THEN 3 WHEN contains(a.href, '/') THEN 4 END AS priority FROM anchors)
SELECT page_id, href, CAST(min(priority) AS BIGINT) AS priority, min(pos) AS pos, arg_min(name, pos) AS name
FROM links WHERE priority IS NOT NULL GROUP BY page_id, href""")
def page_links(spark, sf):
    return P.mock_links(table(spark, sf, "pages"), LINK_PATTERNS)


@query("mock_links", """SELECT c_custkey AS page_id, unnest([
    struct_pack(href := concat('/simulados/', c_custkey), priority := 1, pos := 0, name := 'T&rês'),
    struct_pack(href := concat('/provas/', c_custkey), priority := 2, pos := 1, name := concat('/provas/', c_custkey)),
    struct_pack(href := concat('/practice-tests/?a=', c_custkey, '&b=2'), priority := 3, pos := 2, name := c_mktsegment),
    struct_pack(href := '/meu-simulado', priority := 4, pos := 5, name := 'S')], recursive := true) FROM customer""")
def mock_links(spark, sf):
    """Links of mock exams on pages that write them in every dress."""
    return P.mock_links(link_pages(spark, sf))


@query("notebook_links", """WITH cards AS (
  SELECT concat('1', c_custkey) AS id, c_name AS name, c_custkey AS page, 0 AS pos, CAST(c_custkey AS VARCHAR) AS questions
  FROM customer
  UNION ALL SELECT concat('90', c_nationkey), c_mktsegment, c_custkey, 1, CAST(c_custkey AS VARCHAR) FROM customer
  UNION ALL SELECT concat('7', c_custkey), 'Solto & livre', c_custkey, 2, 'N/A' FROM customer)
SELECT id, arg_min(name, page * 10 + pos) AS name,
  concat('/questoes-de-concursos/questoes?notebook_ids%5B%5D=', id) AS href,
  arg_min(questions, page * 10 + pos) AS questions FROM cards GROUP BY id""")
def notebook_links(spark, sf):
    return P.notebook_links(notebook_pages(spark, sf))


PAGE_URL = "concat('https://q.example/cadernos/', lpad(CAST({} AS VARCHAR), 12, '0'))"


@query("page_order", f"""SELECT {PAGE_URL.format('c_custkey % ' + str(CHAINS))} AS notebook, {PAGE_URL.format('c_custkey')} AS url,
  c_custkey // {CHAINS} + 1 AS position, CAST(1 + c_custkey % 3 AS BIGINT) AS questions,
  CAST(coalesce(sum(1 + c_custkey % 3) OVER (PARTITION BY c_custkey % {CHAINS} ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS BIGINT) AS before,
  CASE WHEN c_custkey + {CHAINS} IN (SELECT c_custkey FROM customer) THEN NULL ELSE CASE c_custkey % {CHAINS} % 5 WHEN 0 THEN 'cycle'
    WHEN 1 THEN 'dangling' WHEN 2 THEN 'merged' ELSE 'last' END END AS ends
  FROM customer""")
def page_order_query(spark, sf):
    """Place of every page in its notebook, by next links, and how many questions stand before it."""
    pages = chained_pages(spark, sf)
    read = P.read_pages(pages.withColumnRenamed("url", "link"))
    counts = read.select(F.col("link").alias("url"), F.size("page.questions").alias("questions"))
    return number_questions(order_pages(next_links(pages)), counts)


@query("page_errors", """SELECT c_custkey AS page_id, 'page' AS part, TRUE AS told FROM customer WHERE c_custkey % 3 = 0""")
def page_errors(spark, sf):
    """What could not be read of pages with broken places."""
    found = P.page_errors(P.read_pages(broken_pages(spark, sf)))
    return found.select("page_id", "part", F.startswith("message", F.lit("ValueError")).alias("told"))


@query("broken_page_questions", """SELECT c_custkey AS page_id, concat('Q', c_custkey, '-', n) AS "ID_Questao"
FROM customer, (SELECT unnest([1, 2]) AS n) WHERE n = 1 OR c_custkey % 3 <> 0""")
def broken_page_questions(spark, sf):
    """Questions kept of pages with broken places."""
    return P.extract_questions(P.read_pages(broken_pages(spark, sf))).select("page_id", "ID_Questao")


SQL_EXTRACT = f"""SELECT doc_id AS page_id, n AS pos, concat('Q', doc_id, '-', n + 1) AS "ID_Questao",
  CAST(n + 1 AS VARCHAR) AS "Indice_Pagina", CAST(2015 + doc_id % 10 AS VARCHAR) AS "Ano", lang AS "Banca",
  source AS "Orgao", NULL AS "Prova", 'Direito' AS "Disciplina", concat('T', doc_id % 17) AS "Assunto",
  CASE n WHEN 0 THEN regexp_replace(text, '^\\s+|\\s+$', '', 'g') ELSE lang END AS "Enunciado",
  CASE WHEN doc_id % 3 = 2 OR n = 0 THEN {_sql_letter('doc_id')} END AS "Resposta_Correta", """ + ", ".join(
    f"""concat('opção {x} ', doc_id) AS "Alternativa_{x}" """ for x in LETTER_LIST) + """
FROM documents, (SELECT unnest([0, 1]) AS n)"""


@query("question_extract", SQL_EXTRACT)
def question_extract(spark, sf):
    """Exam pages parsed to wide question rows, answer key resolved in place."""
    return Q.widen_options(P.extract_questions(P.read_pages(question_pages(spark, sf))))


@query("answer_key_extract", f"""SELECT doc_id AS page_id, '1' AS idx,
  CASE WHEN doc_id % 3 = 0 THEN {_sql_letter('doc_id')} ELSE 'N/A' END AS answer FROM documents""")
def answer_key_extract(spark, sf):
    return P.extract_answer_key(P.read_pages(question_pages(spark, sf), parts=("answers",)))


SQL_SILENT, SQL_PAIR = "(conv_id + turn) % 5 = 4", "(conv_id + turn) % 7 = 6"


@query("mock_extract", f"""SELECT conv_id * 100000 + turn AS page_id, CAST(turn + 1 AS VARCHAR) AS "Numero_Questao",
  CASE WHEN (conv_id + turn) % 3 = 0 THEN 'Certa' ELSE 'Errada' END AS "Resultado",
  regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS "Enunciado",
  CASE WHEN {SQL_SILENT} THEN 'B' ELSE {_sql_letter('conv_id')} END AS "Resposta_Marcada",
  CASE WHEN {SQL_SILENT} THEN 'B' WHEN (conv_id + turn) % 3 = 0 THEN {_sql_letter('conv_id')}
       ELSE {_sql_letter('conv_id + turn + 1')} END AS "Resposta_Correta",
  regexp_replace(concat(role, chr(10), regexp_replace(text, '^\\s+|\\s+$', '', 'g')),
                 '\\n{{3,}}', chr(10) || chr(10), 'g') AS "Comentario_Professor",
  {", ".join(f"""CASE WHEN {SQL_PAIR} THEN 'N/A' ELSE concat('opção {x} ', role) END AS "Alternativa_{x}" """ for x in "ABD")},
  'N/A' AS "Alternativa_C", 'N/A' AS "Alternativa_E",
  {", ".join(f"""CASE WHEN {SQL_PAIR} THEN '{w}' ELSE 'N/A' END AS "Alternativa_{w}" """ for w in ("Certo", "Errado"))}
FROM conversations""")
def mock_extract(spark, sf):
    """Mock-exam pages as wide rows, with N/A where something is absent."""
    return P.widen_mock_exam(P.extract_mock_exam(P.read_pages(mock_pages(spark, sf)))).drop("pos")


SENTENCE_SQL = f"""CASE WHEN doc_id % 4 = 0 THEN 'sem resposta'
  WHEN doc_id % 4 = 1 THEN concat('Correto! Você marcou a resposta ', {_sql_letter('doc_id')}, '.')
  ELSE concat('Você marcou a resposta ', {_sql_letter('doc_id')}, ', mas a alternativa correta é ',
    {_sql_letter('n_chars')}, '.', chr(10), text) END"""


@query("mock_answer_regex", f"""WITH s AS (SELECT doc_id, {SENTENCE_SQL} AS sentence FROM documents)
SELECT doc_id,
  coalesce(nullif(regexp_extract(sentence, '(?is)marcou a resposta\\s+(\\w+).*?correta[^é]*é\\s+([A-Z\\d]+)', 1), ''),
    nullif(regexp_extract(sentence, '(?i)marcou a resposta\\s+([A-Z\\d]+)', 1), ''), 'N/A') AS chosen,
  coalesce(nullif(regexp_extract(sentence, '(?is)marcou a resposta\\s+(\\w+).*?correta[^é]*é\\s+([A-Z\\d]+)', 2), ''),
    nullif(regexp_extract(sentence, '(?i)marcou a resposta\\s+([A-Z\\d]+)', 1), ''), 'N/A') AS correct
FROM s""")
def mock_answer_regex(spark, sf):
    doc = F.col("doc_id")
    sentence = (
        F.when(doc % 4 == 0, "sem resposta")
        .when(doc % 4 == 1, F.concat(F.lit("Correto! Você marcou a resposta "), letter_at(doc), F.lit(".")))
        .otherwise(F.concat(F.lit("Você marcou a resposta "), letter_at(doc), F.lit(", mas a alternativa correta é "),
                            letter_at(F.col("n_chars")), F.lit(".\n"), "text")))
    return table(spark, sf, "documents").withColumn("s", sentence).select(
        "doc_id", F.coalesce(P.chosen_answer(F.col("s")), F.lit("N/A")).alias("chosen"),
        F.coalesce(P.correct_answer(F.col("s")), F.lit("N/A")).alias("correct"))


# --- question tables -------------------------------------------------------------------------


@query("answer_key", f"""SELECT d.doc_id, coalesce(
    CASE WHEN l.doc_id IS NOT NULL THEN {_sql_letter('l.doc_id + l.quality')} END,
    CASE WHEN d.doc_id % 3 = 1 THEN {_sql_letter('d.doc_id')} WHEN d.doc_id % 3 = 2 THEN NULL END,
    CASE WHEN d.doc_id % 2 = 0 THEN {_sql_letter('d.n_chars')} END, 'N/A') AS "Resposta_Correta"
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def answer_key(spark, sf):
    """Answers from a separate key table, with both fallbacks. A page holds ten questions."""
    doc = F.col("doc_id")
    place = [F.floor(doc / 10).alias("page_id"), (doc % 10).cast("string").alias("idx")]
    key = table(spark, sf, "labels").select(*place, letter_at(doc + F.col("quality")).alias("answer"))
    asked = table(spark, sf, "documents").select(
        "doc_id", *place, F.when(doc % 3 == 1, letter_at(doc)).when(doc % 3 == 0, "N/A").alias("own"),
        F.when(doc % 2 == 0, letter_at(F.col("n_chars"))).alias("marked"))
    return P.resolve_answers(asked, key).select("doc_id", "Resposta_Correta")


@query("question_wide", "SELECT conv_id AS id, " + ", ".join(
    f"coalesce(arg_max(text, turn) FILTER (WHERE turn % 5 = {i}), '') AS \"Alternativa_{x}\""
    for i, x in enumerate(LETTER_LIST)) + " FROM conversations GROUP BY conv_id")
def question_wide(spark, sf):
    options = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("id"), letter_at(F.col("turn")).alias("letter"), "text", "turn")
    return Q.pivot_options(options, "id", "turn")


def _sql_or(column, default):
    trimmed = f"trim(CAST({column} AS VARCHAR))"
    return f"coalesce(CASE WHEN lower({trimmed}) NOT IN ('', 'nan', 'none') THEN {trimmed} END, {default})"


SQL_RECORD = f"""SELECT {_sql_or('ID_Questao', "concat('Q', doc_id)")} AS id_questao, 'Direito' AS disciplina,
  {_sql_or('Banca', "'N/A'")} AS banca, {_sql_or('Ano', "'N/A'")} AS ano, {_sql_or('Orgao', "'N/A'")} AS orgao,
  'N/A' AS prova, {_sql_or('Assunto', "'N/A'")} AS assunto, {_sql_or('Enunciado', "'N/A'")} AS enunciado,
  {_sql_or('Alternativa_A', "'N/A'")} AS alt_a, {_sql_or('Alternativa_B', "'N/A'")} AS alt_b,
  'N/A' AS alt_c, 'N/A' AS alt_d, 'N/A' AS alt_e,
  upper({_sql_or('Resposta_Correta', "'N/A'")}) AS gabarito FROM questions"""


def records(spark, sf):
    return Q.question_record(questions(spark, sf), "doc_id", subject="Direito")


@query("question_record", f"{QUESTIONS} {SQL_RECORD}")
def question_record(spark, sf):
    return records(spark, sf)


PROMPT = ("Banca: {banca} ({ano})\nÓrgão: {orgao}\nAssunto: {assunto}\n{{questão}} {enunciado}\n"
          "A) {alt_a}\nB) {alt_b}\nC) {alt_c}\nGabarito: {gabarito}")


@query("prompt_text", f"""{QUESTIONS}, records AS ({SQL_RECORD})
SELECT id_questao, concat('Banca: ', banca, ' (', ano, ')', chr(10), 'Órgão: ', orgao, chr(10), 'Assunto: ', assunto,
  chr(10), '{{questão}} ', enunciado, chr(10), 'A) ', alt_a, chr(10), 'B) ', alt_b, chr(10),
  'C) ', alt_c, chr(10), 'Gabarito: ', gabarito) AS prompt FROM records""")
def prompt_text(spark, sf):
    frame = records(spark, sf)
    values = {c: F.col(c) for c in frame.columns}
    return frame.select("id_questao", S.render_prompt(PROMPT, **values).alias("prompt"))


@query("output_name", f"""{QUESTIONS}, records AS ({SQL_RECORD})
SELECT id_questao, regexp_replace(concat_ws('_', concat('Q', lpad(substr(id_questao, 2), CAST(greatest(3,
    length(id_questao) - 1) AS INTEGER), '0')), ano, orgao, substr(replace(replace(assunto, ' ', '_'), '/', '-'), 1, 40),
    concat('GAB', gabarito)), '[^\\p{{L}}\\p{{N}}_.\\-]', '', 'g') AS name,
  regexp_replace(concat_ws('_', concat('Q', lpad(substr(id_questao, 2), CAST(greatest(3, length(id_questao) - 1) AS INTEGER), '0')),
    substr(replace(banca, ' ', '_'), 1, 15), ano, substr(replace(replace(assunto, ' ', '_'), '/', '-'), 1, 40),
    concat('GAB', gabarito)), '[^\\p{{L}}\\p{{N}}_.\\-]', '', 'g') AS board_name FROM records""")
def output_name(spark, sf):
    number = F.substr("id_questao", F.lit(2)).cast("long")
    return records(spark, sf).select("id_questao", Q.output_name(number).alias("name"),
                                     Q.output_name(number, "banca", 15).alias("board_name"))


@query("content_key", f"""{QUESTIONS} SELECT doc_id, md5(concat(coalesce(Enunciado, ''), '||',
  coalesce(Resposta_Correta, ''), '||', coalesce(Comentario_Professor, ''))) AS key FROM questions""")
def content_key(spark, sf):
    return questions(spark, sf).select(
        "doc_id", Q.content_key("Enunciado", "Resposta_Correta", "Comentario_Professor").alias("key"))


@query("normalize_answer", f"""{QUESTIONS} SELECT Resposta_Correta AS raw, count(*) AS n,
  upper(Resposta_Correta) AS answer, Resposta_Correta AS loose FROM questions GROUP BY Resposta_Correta""")
def normalize_answer_query(spark, sf):
    worded = F.concat(F.lit("Alternativa: "), F.lower("raw"), F.lit(" "))
    return (questions(spark, sf).groupBy(F.col("Resposta_Correta").alias("raw")).agg(F.count("*").alias("n"))
            .select("raw", "n", normalize_answer(worded).alias("answer"),
                    profile_answer(F.concat(F.lit("Alternativa "), "raw", F.lit(" "))).alias("loose")))


@query("slug", r"""SELECT page_id, regexp_replace(replace(replace(url, ' ', '_'), '-', '_'), '[^\p{L}\p{N}_.]', '', 'g')
    AS slug, regexp_replace(url, '[^\p{L}\p{N}_.\-]', '_', 'g') AS safe FROM pages""")
def slug_query(spark, sf):
    return table(spark, sf, "pages").select("page_id", slug(F.col("url")).alias("slug"),
                                            safe_file_name(F.col("url")).alias("safe"))


def _sql_escape(text, quotes=True):
    pairs = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")] + ([('"', "&quot;"), ("''", "&#39;")] if quotes else [])
    for mark, entity in pairs:
        text = f"replace({text}, '{mark}', '{entity}')"
    return text


@query("html_escape", f"""SELECT page_id, coalesce({_sql_escape('html')}, 'N/A') AS escaped,
  {_sql_escape('html', False)} AS compact FROM pages""")
def html_escape_query(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", html_escape(F.col("html")).alias("escaped"),
        html_escape(F.col("html"), quotes=False, missing=None).alias("compact"))


# --- selection and cache ---------------------------------------------------------------------


@query("wrong_answers", f"""{QUESTIONS} SELECT doc_id, ID_Questao FROM questions
  WHERE lower(Resultado) IN ('errada', 'incorreta', 'wrong', 'false')""")
def wrong_answers(spark, sf):
    return Q.wrong_answers(questions(spark, sf)).select("doc_id", "ID_Questao")


@query("answered_rate", f"""{QUESTIONS} SELECT count(*) FILTER (WHERE Resposta_Correta <> 'N/A') AS found,
  count(*) AS total FROM questions""")
def answered_rate(spark, sf):
    return Q.answered_rate(questions(spark, sf))


@query("pick_items", ANCHORS_SQL + """
SELECT page_id, a.pos + 1 AS number, a.href AS href FROM anchors WHERE a.pos + 1 IN (1, 4, 999)""")
def pick_items(spark, sf):
    """The links a person picks by number from the listing of each page."""
    listing = P.page_anchors(table(spark, sf, "pages")).select(
        "page_id", (F.col("pos") + 1).alias("number"), "href")
    return Q.pick_items(listing, "number", "1, 4, 999")


def work_and_cache(spark, sf):
    """Questions to analyse, and the labelled documents as the analyses already stored."""
    docs = table(spark, sf, "documents")
    work = docs.select(F.col("doc_id").alias("key"), "lang", "n_chars")
    cache = table(spark, sf, "labels").select(F.col("doc_id").alias("key"), F.col("quality").alias("score"))
    return work, cache


@query("cache_hits", """SELECT d.doc_id AS key, lang, n_chars, quality AS score
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def cache_hits_query(spark, sf):
    return cache_hits(*work_and_cache(spark, sf))


@query("cache_misses", """SELECT doc_id AS key, lang, n_chars FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def cache_misses_query(spark, sf):
    return cache_misses(*work_and_cache(spark, sf))


@query("cache_appended", """WITH runs AS (
  SELECT doc_id AS key, quality AS score, 1 AS run FROM labels WHERE quality = 1
  UNION ALL SELECT doc_id, quality + 10, 1 FROM labels WHERE quality = 1
  UNION ALL SELECT doc_id, quality + 20, 2 FROM labels)
SELECT d.doc_id AS key, d.lang, d.n_chars, CAST(min_score AS BIGINT) AS score FROM documents d JOIN (
  SELECT key, arg_min(score, run * 100 + score) AS min_score FROM runs WHERE key IS NOT NULL GROUP BY key) ON key = d.doc_id""")
def cache_appended(spark, sf):
    """Two runs store analyses of the labelled documents, the second over all of them; what is stored is looked up. Of each
    key the first run's lowest score stays."""
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("key"), F.col("quality").cast("long").alias("score"))
    good = labels.where("score = 1")
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("score", T.LongType())])
    store = KeyedCache(f"{staging_folder(spark)}/cache-{uuid.uuid4().hex}", schema, buckets=16)
    store.append(good.unionByName(good.withColumn("score", F.col("score") + 10)), version=1, first=["score"])
    store.append(labels.withColumn("score", F.col("score") + 20), version=2, first=["score"])
    return store.hits(work_and_cache(spark, sf)[0])


@query("comment_status", f"""{QUESTIONS} SELECT Banca AS banca,
  count(*) FILTER (WHERE Comentario_Professor IS NULL OR lower(trim(Comentario_Professor)) IN ('', 'n/a', 'nan', 'none'))
    AS lacking, count(*) AS total FROM questions GROUP BY 1""")
def comment_status(spark, sf):
    frame = questions(spark, sf).withColumn(
        "summary", S.summary_or_fallback(F.col("Comentario_Professor"), F.lit("resumo")))
    return frame.groupBy(F.col("Banca").alias("banca")).agg(
        F.count_if(F.col("summary") == S.NO_COMMENT_SUMMARY).alias("lacking"), F.count("*").alias("total"))


# --- profiles --------------------------------------------------------------------------------


@query("bank_profile", f"""{QUESTIONS} SELECT count(*) AS total, count(DISTINCT Banca) AS bancas,
  count(DISTINCT Ano) AS anos, count(DISTINCT Orgao) AS orgaos, count(DISTINCT Assunto) AS assuntos,
  arg_min(Banca, ID_Questao) AS primeira_banca FROM questions""")
def bank_profile(spark, sf):
    return Q.bank_profile(questions(spark, sf))


def _sql_shares(column):
    return f"""{QUESTIONS} SELECT {column} AS value, count(*) AS n,
  round(count(*) * 100.0 / (SELECT count(*) FROM questions), 1) AS pct FROM questions
  WHERE {column} IS NOT NULL GROUP BY 1"""


@query("answer_share", _sql_shares("Resposta_Correta"))
def answer_share(spark, sf):
    return Q.value_shares(questions(spark, sf), "Resposta_Correta").orderBy("value")


@query("by_year", _sql_shares("Ano"))
def by_year(spark, sf):
    return Q.value_shares(questions(spark, sf), "Ano").orderBy(F.desc("value"))


@query("top_bodies", f"""{QUESTIONS} SELECT Orgao AS value, count(*) AS n FROM questions GROUP BY 1
  ORDER BY n DESC, value LIMIT 10""")
def top_bodies(spark, sf):
    return Q.top_values(questions(spark, sf), "Orgao", 10)


@query("top_topics", f"""{QUESTIONS} SELECT Assunto AS value, count(*) AS n FROM questions GROUP BY 1
  ORDER BY n DESC, value LIMIT 5""")
def top_topics(spark, sf):
    return Q.top_values(questions(spark, sf), "Assunto", 5)


@query("answer_chi_square", f"""{QUESTIONS}, counts AS (
  SELECT Resposta_Correta AS letter, count(*) AS n FROM questions GROUP BY 1),
  e AS (SELECT sum(n) / 5.0 AS expected FROM counts)
  SELECT round(any_value(expected), 1) AS expected, round(sum((n - expected) * (n - expected) / expected), 2) AS chi_square,
    sum((n - expected) * (n - expected) / expected) < 9.49 AS uniform FROM counts, e WHERE letter IS NOT NULL""")
def answer_chi_square(spark, sf):
    return Q.chi_square(questions(spark, sf), "Resposta_Correta")


@query("mock_score", f"""{QUESTIONS} SELECT count(*) FILTER (WHERE Resultado = 'Certa') AS certas,
  count(*) FILTER (WHERE Resultado = 'Errada') AS erradas, count(*) AS total FROM questions""")
def mock_score(spark, sf):
    return Q.mock_score(questions(spark, sf))


# --- scores ----------------------------------------------------------------------------------


def _sql_has(text, *terms):
    return "(" + " OR ".join(f"contains({text}, '{t}')" for t in terms) + ")"


def _sql_points(condition, points):
    return f"CASE WHEN {condition} THEN {points} ELSE 0 END"


def _sql_steps(value, steps):
    return "CASE " + " ".join(f"WHEN {value} >= {b} THEN {p}" for b, p in steps) + " ELSE 0 END"


SQL_MARKS = "len(regexp_extract_all(text, '[✅❌]'))"


def _sql_long_form(groups, extra=()):
    structure = " AND ".join([
        f"({_sql_has('upper(text)', 'IDENTIFICAÇÃO')} OR {_sql_has('text', '1️⃣')})",
        f"({_sql_has('upper(text)', 'CONCEITOS')} OR {_sql_has('text', '2️⃣')})",
        _sql_has("upper(text)", "GABARITO")])
    terms = [_sql_steps("length(text)", R.LENGTH_STEPS)]
    terms += [_sql_points(_sql_has("upper(text)", f"ALTERNATIVA {x}"), 12) for x in LETTER_LIST]
    terms += [_sql_steps(SQL_MARKS, ((5, 10), (3, 5)))]
    terms += [_sql_points(_sql_has("lower(text)", *g), 2) for g in groups]
    terms += [_sql_points(structure, 10),
              _sql_points(f"{_sql_has('lower(text)', 'pegadinha')} OR {_sql_has('text', '⚠️')}", 8), *extra]
    return f"CAST(least({' + '.join(terms)}, 100) AS BIGINT)"


SQL_SCORES = {
    "score_law": _sql_long_form(R.LAW_TERMS),
    "score_language": _sql_long_form(
        R.LANGUAGE_TERMS, [_sql_points(_sql_has("lower(text)", *R.TECHNICAL_TERMS), 5)]),
    "score_compact": "CAST(least(" + " + ".join(
        [_sql_steps("length(text)", ((2000, 20),))]
        + [_sql_points(f"{_sql_has('upper(text)', f'ALTERNATIVA {x}')} OR {_sql_has('text', f'{x}:')}", 12)
           for x in LETTER_LIST]
        + [f"least(coalesce({SQL_MARKS}, 0) * 2, 10)", _sql_points(_sql_has("upper(text)", "GABARITO"), 10)]
        + [_sql_points(_sql_has("lower(text)", t), 5) for t in R.COMPACT_TERMS]) + ", 100) AS BIGINT)",
    "score_summary": "CAST(least(" + " + ".join(
        ["CASE WHEN length(bare) BETWEEN 300 AND 1800 THEN 30 WHEN length(bare) BETWEEN 200 AND 2200 THEN 20 "
         "WHEN length(bare) > 100 THEN 10 ELSE 0 END"]
        + [_sql_points(_sql_has("bare", h), 10) for h in R.SUMMARY_HEADINGS]
        + [_sql_points("contains(bare, chr(10))", 10),
           _sql_points("NOT " + _sql_has("lower(bare)", *R.SUMMARY_BAD_TERMS), 10),
           _sql_points(_sql_has("bare", R.SUMMARY_HEADINGS[-1])
                       + r" AND len(regexp_extract_all(bare, '\S+')) >= 40", 10)]) + ", 100) AS BIGINT)",
}
SCORERS = {"score_law": R.score_law, "score_language": R.score_language, "score_compact": R.score_compact,
           "score_summary": R.score_summary}
SQL_BARE = r"regexp_replace(text, '^\s+|\s+$', '', 'g') AS bare"


# Every 29th text is absent.
SQL_SOME_NULL = "SELECT * REPLACE (CASE WHEN doc_id % 29 <> 0 THEN text END AS text) FROM analyses"


def _score(scorer):
    return lambda spark, sf: analyses(spark, sf).select(
        "doc_id", scorer(F.when(F.col("doc_id") % 29 != 0, F.col("text"))).alias("score"))


for _name, _scorer in SCORERS.items():
    query(_name, f"""{ANALYSES} SELECT doc_id, {SQL_SCORES[_name]} AS score
  FROM (SELECT *, {SQL_BARE} FROM ({SQL_SOME_NULL}))""")(_score(_scorer))


# --- attempts and run figures ----------------------------------------------------------------

SQL_SCORED = f"""WITH scored AS (SELECT doc_id, attempt, text, {SQL_SCORES['score_law']} AS score
  FROM ({ATTEMPTS_SQL}))"""


def scored_attempts(spark, sf):
    return attempts(spark, sf).withColumn("score", R.score_law(F.col("text")))


@query("best_attempt", f"""{SQL_SCORED}, picked AS (SELECT doc_id,
    coalesce(min(attempt) FILTER (WHERE score >= 65), max(attempt)) AS attempt FROM scored GROUP BY doc_id)
  SELECT doc_id, CAST(attempt AS BIGINT) AS attempt, score, length(text) AS chars
  FROM picked JOIN scored USING (doc_id, attempt)""")
def best_attempt(spark, sf):
    scored = scored_attempts(spark, sf).withColumn("chars", F.length("text").cast("long"))
    return S.best_attempt(scored, "doc_id", R.LONG_ACCEPT, carry=["chars"])


@query("attempt_text", f"""{SQL_SCORED}, picked AS (SELECT doc_id,
    coalesce(min(attempt) FILTER (WHERE score >= 65), max(attempt)) AS attempt FROM scored GROUP BY doc_id)
  SELECT doc_id, CAST(attempt AS BIGINT) AS attempt, score, md5(text) AS text_md5
  FROM picked JOIN scored USING (doc_id, attempt)""")
def attempt_text(spark, sf):
    """The chosen attempts with their texts."""
    picked = S.best_attempt(scored_attempts(spark, sf), "doc_id", R.LONG_ACCEPT)
    return S.with_attempt_text(picked, attempts(spark, sf), "doc_id").select(
        "doc_id", "attempt", "score", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("mean_seconds", """WITH ends AS (SELECT max(epoch_us(ts)) - min(epoch_us(ts)) AS us, count(*) AS n FROM events)
  SELECT us / 1e6 AS seconds, us / 1e6 / n AS mean_seconds FROM ends""")
def mean_seconds(spark, sf):
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return S.mean_seconds(events, "ts", "ts")


@query("run_summary", f"""WITH attempts AS ({ATTEMPTS_SQL})
  SELECT count(*) AS total, count(*) FILTER (WHERE NOT starts_with(text, '❌')) AS successes,
    count(*) FILTER (WHERE starts_with(text, '❌')) AS errors,
    round(count(*) FILTER (WHERE NOT starts_with(text, '❌')) * 100.0 / count(*), 1) AS success_pct,
    round(count(*) FILTER (WHERE starts_with(text, '❌')) * 100.0 / count(*), 1) AS error_pct,
    round(count(*) FILTER (WHERE NOT starts_with(text, '❌')) * 0.003::DOUBLE, 2) AS cost FROM attempts""")
def run_summary(spark, sf):
    return S.run_summary(attempts(spark, sf), 0.003)


@query("run_estimate", """WITH counted AS (SELECT source, concat('us.x-', CASE length(source) % 3
    WHEN 0 THEN 'haiku-4-5' WHEN 1 THEN '3-5-Haiku' ELSE 'other' END) AS model, count(*) AS n
  FROM documents GROUP BY ALL)
SELECT source, model, n,
  round(n * CASE WHEN contains(model, 'haiku-4-5') THEN 15 WHEN contains(model, 'Haiku') THEN 10 ELSE 20 END / 60.0, 1)
    AS minutes,
  round(n * CASE WHEN contains(model, 'haiku-4-5') THEN 0.001::DOUBLE WHEN contains(model, 'Haiku') THEN 0.0008::DOUBLE
    ELSE 0.003::DOUBLE END, 2) AS cost FROM counted""")
def run_estimate(spark, sf):
    size = F.length("source") % 3
    model = F.concat(F.lit("us.x-"), F.when(size == 0, "haiku-4-5").when(size == 1, "3-5-Haiku").otherwise("other"))
    counted = (table(spark, sf, "documents").groupBy("source", model.alias("model"))
               .agg(F.count("*").alias("n")))
    return counted.select("*", *S.run_estimate(F.col("n"), F.col("model")))


@query("speech_stats", r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS words,
  round(len(regexp_extract_all(text, '\S+')) / 150, 1) AS minutes,
  round(length(text) / 1e6 * CASE WHEN lang = 'en' THEN 16 ELSE 4 END, 6) AS speech_cost,
  length(text) // 4 AS tokens, round((length(text) // 4) / 1000 * 0.018::DOUBLE, 6) AS token_cost FROM documents""")
def speech_stats(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", *S.speech_stats(F.col("text"), F.col("lang") == "en"))


# --- booklets --------------------------------------------------------------------------------

SQL_FRAGMENT = f"""concat('<div class="questao"><div class="num">QUESTÃO ', doc_id + 1,
  '</div><div class="enunciado">', coalesce({_sql_escape('Enunciado', False)}, 'N/A'),
  '</div><div class="alternativas"><div class="',
  CASE WHEN Resposta_Correta = 'A' THEN 'alt correta' ELSE 'alt' END, '"><b>A)</b> ',
  {_sql_escape('Alternativa_A', False)}, '</div><div class="',
  CASE WHEN Resposta_Correta = 'B' THEN 'alt correta' ELSE 'alt' END, '"><b>B)</b> ',
  coalesce({_sql_escape('Alternativa_B', False)}, ''), '</div></div><div class="analise">',
  replace(coalesce({_sql_escape('Comentario_Professor', False)}, 'N/A'), chr(10), '<br/>'), '</div></div>')"""


@query("booklet", f"""{QUESTIONS} SELECT Orgao AS booklet, doc_id // 200 + 1 AS volume, count(*) AS questions,
  string_agg({SQL_FRAGMENT}, chr(10) ORDER BY doc_id) AS body FROM questions
  WHERE lower(Resultado) IN ('errada', 'incorreta') GROUP BY 1, 2""")
def booklet(spark, sf):
    """Booklets of the wrongly answered questions of each body."""
    wrong = Q.wrong_answers(questions(spark, sf), Q.WRONG_RESULTS_SHORT)
    number = (F.col("doc_id") + 1).alias("number")
    fragments = wrong.select(
        F.col("Orgao").alias("booklet"), number,
        S.fragment_html(F.col("doc_id") + 1, F.col("Enunciado"),
                        {"A": F.col("Alternativa_A"), "B": F.col("Alternativa_B")},
                        F.col("Resposta_Correta"), F.col("Comentario_Professor")).alias("fragment"))
    return S.booklet(fragments, "booklet", volume_size=200)


@query("rich_fragment", f"""SELECT doc_id, regexp_replace(replace(replace({_sql_escape("marked")},
    chr(10) || chr(10), '</p><p>'), chr(10), '<br/>'), '\\*\\*(.+?)\\*\\*', '<b>\\1</b>', 'g') AS html
  FROM (SELECT doc_id, concat('**', lang, '** & <', source, '>', chr(10), chr(10), text, chr(10), '**fim**') AS marked
        FROM documents)""")
def rich_fragment(spark, sf):
    """Texts with paragraphs, line breaks and bold words as tags."""
    marked = F.concat(F.lit("**"), "lang", F.lit("** & <"), "source", F.lit(">\n\n"), "text", F.lit("\n**fim**"))
    return table(spark, sf, "documents").select("doc_id", S.rich_text(marked).alias("html"))


@query("text_report", f"""{QUESTIONS} SELECT doc_id, concat(repeat('=', 50), chr(10), 'ANÁLISE DE QUESTÃO', chr(10), repeat('=', 50),
  chr(10), chr(10), 'ENUNCIADO', chr(10), Enunciado, chr(10), chr(10), 'ALTERNATIVAS', chr(10),
  concat('A) ', Alternativa_A, ' B) ', coalesce(Alternativa_B, 'N/A')), chr(10), chr(10), 'RESPOSTA CORRETA', chr(10), Resposta_Correta,
  chr(10), chr(10), 'COMENTÁRIO DO PROFESSOR', chr(10), coalesce(Comentario_Professor, 'N/A'), chr(10), chr(10), repeat('-', 50), chr(10),
  'RESUMO GERADO PELA IA', chr(10), repeat('-', 50), chr(10), chr(10), CASE WHEN Resultado = 'Certa' THEN 'breve' ELSE 'N/A' END,
  chr(10), chr(10), repeat('=', 50)) AS report FROM questions""")
def text_report(spark, sf):
    options = F.concat(F.lit("A) "), "Alternativa_A", F.lit(" B) "), F.coalesce("Alternativa_B", F.lit("N/A")))
    return questions(spark, sf).select("doc_id", S.text_report(
        F.col("Enunciado"), options, F.col("Resposta_Correta"), F.col("Comentario_Professor"),
        F.when(F.col("Resultado") == "Certa", "breve")).alias("report"))

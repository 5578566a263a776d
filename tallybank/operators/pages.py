"""Exam pages to question rows.

Python only reads tags: it returns, per page, the raw texts found at known places. Everything that
decides something (answer-key lookup and its fallbacks, defaults, sentence patterns, right or wrong)
is a column expression on those texts.
"""

from __future__ import annotations

from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Class names that mark the places on a page.
ITEM_CLASS = "js-question-item"
BLOCK_CLASS = "q-answer-sheet-question"
CARD_CLASS = "q-content"

PARTS = ("questions", "answers", "blocks")

VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN_TAGS = ("script", "style")

def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_TEXT = T.StringType()
_OPTIONS = T.ArrayType(_struct(("letter", _TEXT), ("text", _TEXT), ("checked", T.BooleanType()),
                               ("correct", T.BooleanType())))
_QUESTION = _struct(("qid", _TEXT), ("idx", _TEXT), ("statement", _TEXT),
                    ("info", T.ArrayType(_struct(("label", _TEXT), ("link", _TEXT)))),
                    ("crumbs", T.ArrayType(_TEXT)), ("options", _OPTIONS), ("right_answer", _TEXT))
_BLOCK = _struct(("short", _TEXT), ("full", _TEXT), ("ok_text", _TEXT), ("bad_text", _TEXT), ("sentence", _TEXT),
                 ("options", _OPTIONS), ("checked", _TEXT), ("comment", _TEXT))
_PROBLEM = _struct(("part", _TEXT), ("pos", T.IntegerType()), ("message", _TEXT))
PAGE_TYPE = _struct(("questions", T.ArrayType(_QUESTION)),
                    ("answers", T.ArrayType(_struct(("idx", _TEXT), ("answer", _TEXT), ("last", T.BooleanType())))),
                    ("blocks", T.ArrayType(_BLOCK)), ("problems", T.ArrayType(_PROBLEM)))
_LINK = _struct(("href", _TEXT), ("name", _TEXT), ("subtitle", _TEXT), ("first", T.BooleanType()), ("turn", T.BooleanType()),
                ("off", T.BooleanType()))
LINKS_TYPE = _struct(("links", T.ArrayType(_LINK)), ("problems", T.ArrayType(_PROBLEM)))


class _Node:
    __slots__ = ("tag", "attrs", "classes", "parts", "above")

    def __init__(self, tag, attrs, above=None):
        self.tag, self.attrs, self.parts, self.above = tag, dict(attrs), [], above
        self.classes = (self.attrs.get("class") or "").split()

    def find_all(self, tag, css=None):
        stack = list(reversed(self.parts))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                continue
            if node.tag == tag and (css is None or css in node.classes):
                yield node
            stack.extend(reversed(node.parts))

    def find(self, tag, css=None):
        return next(self.find_all(tag, css), None)

    def enclosing(self, tag, css):
        node = self.above
        while node is not None and not (node.tag == tag and css in node.classes):
            node = node.above
        return node

    def text(self, joiner=""):
        pieces, stack = [], list(reversed(self.parts))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                if node.strip():
                    pieces.append(node.strip())
            elif node.tag not in HIDDEN_TAGS:
                stack.extend(reversed(node.parts))
        return joiner.join(pieces)


class _Tree(HTMLParser):
    def __init__(self):
        # Entities are decoded piece by piece, so that one which can't be decoded costs only itself.
        super().__init__(convert_charrefs=False)
        self.root = _Node("", [])
        self.open = [self.root]

    def updatepos(self, i, j):
        return j                                 # lines are not counted, as nobody asks for them

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, attrs, self.open[-1])
        self.open[-1].parts.append(node)
        if tag not in VOID_TAGS:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].parts.append(_Node(tag, attrs, self.open[-1]))

    def handle_endtag(self, tag):
        depth = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i].tag == tag), None)
        if depth is not None:
            del self.open[depth:]

    def handle_data(self, data):
        parts = self.open[-1].parts
        if parts and isinstance(parts[-1], str):
            parts[-1] += data
        else:
            parts.append(data)

    def handle_entityref(self, name):
        self.handle_data(unescape(f"&{name};"))

    def handle_charref(self, name):
        try:
            self.handle_data(unescape(f"&#{name};"))
        except ValueError:                       # more digits than Python turns into a number
            self.handle_data(f"&#{name};")


def _text(node, joiner=""):
    return node.text(joiner) if node else None


def _options(holder, joiner):
    found = []
    for label in holder.find_all("label", "q-radio-button") if holder else ():
        radio = next((n for n in label.find_all("input") if n.attrs.get("type") == "radio"), None)
        found.append({
            "letter": radio.attrs.get("value") if radio else None,
            "text": _text(label.find("div", "q-item-enum"), joiner) or "",
            "checked": bool(radio) and "checked" in radio.attrs,
            "correct": "q-correct" in label.classes,
        })
    return found


def _question(item):
    holder, info = item.find("div", "js-question"), item.find("div", "q-question-info")
    crumbs = item.find("div", "q-question-breadcrumb")
    return {
        "qid": holder.attrs.get("data-question-id") if holder else None,
        "idx": _text(item.find("span", "q-index")),
        "statement": _text(item.find("div", "q-question-enunciation")),
        "info": [{"label": s.text(), "link": _text(s.find("a"))} for s in info.find_all("span")] if info else [],
        "crumbs": [a.text() for a in crumbs.find_all("a")] if crumbs else [],
        "options": _options(item.find("div", "q-question-options"), ""),
        "right_answer": _text(item.find("span", "js-question-right-answer")),
    }


def _block(block):
    return {
        "short": _text(block.find("span", "q-resumed-statement"), " "),
        "full": _text(block.find("div", "q-question-enunciation"), " "),
        "ok_text": _text(block.find("span", "q-correct")),
        "bad_text": _text(block.find("span", "q-incorrect")),
        "sentence": _text(block.find("div", "q-answer"), " "),
        "options": _options(block.find("ul", "q-question-options"), " "),
        "checked": next((n.attrs.get("value") for n in block.find_all("input")
                         if n.attrs.get("type") == "radio" and "checked" in n.attrs), None),
        "comment": _text(block.find("div", "q-text"), "\n"),
    }


def _entries(root):
    sheet = root.find("fieldset", "q-questions-feedback")
    return sheet.find_all("div", "q-feedback") if sheet else ()


def _entry(entry):
    idx, answer = entry.find("span", "q-index"), entry.find("span", "q-answer")
    return {"idx": idx.text().replace(":", ""), "answer": answer.text()} if idx and answer else None


def _link(anchor):
    card = anchor.enclosing("div", CARD_CLASS)
    css = anchor.attrs.get("class") or ""
    return {"href": anchor.attrs.get("href"), "name": anchor.text(),
            "turn": anchor.attrs.get("rel") == "next" or "next" in css, "off": "disabled" in css,
            "subtitle": _text(card.find("div", "q-subtitle")) if card else None}


def _tree(html: str, problems: list) -> _Node:
    tree = _Tree()
    try:
        tree.feed(html or "")
        tree.close()
    except Exception as error:  # noqa: BLE001 - kept as a row; what was read until then stays
        problems.append({"part": "page", "pos": None, "message": f"{type(error).__name__}: {error}"})
    return tree.root


def _each(part: str, nodes, read, problems: list) -> list:
    """What ``read`` makes of each node. A node that it can't read is skipped and reported."""
    found = []
    for pos, node in enumerate(nodes):
        try:
            if (value := read(node)) is not None:
                found.append(value)
        except Exception as error:  # noqa: BLE001 - kept as a row
            problems.append({"part": part, "pos": pos, "message": f"{type(error).__name__}: {error}"})
    return found


def read_page(html: str, parts=PARTS) -> dict:
    """Raw texts of one page, and what could not be read of it; only those of some ``parts``, if no others are wanted."""
    problems: list = []
    root = _tree(html, problems)

    def nodes(part, css):
        return root.find_all("div", css) if part in parts else ()

    answers = _each("answer", _entries(root) if "answers" in parts else (), _entry, problems)
    last = {entry["idx"]: place for place, entry in enumerate(answers)}
    for place, entry in enumerate(answers):
        entry["last"] = last[entry["idx"]] == place
    return {"questions": _each("question", nodes("questions", ITEM_CLASS), _question, problems),
            "answers": answers,
            "blocks": _each("block", nodes("blocks", BLOCK_CLASS), _block, problems), "problems": problems}


def read_links(html: str) -> dict:
    """Links of one page in their order, with decoded addresses and the subtitle of the card around them."""
    problems: list = []
    root = _tree(html, problems)
    anchors = (a for a in root.find_all("a") if a.attrs.get("href") is not None)
    links, seen = _each("link", anchors, _link, problems), set()
    for link in links:
        link["first"] = link["href"] not in seen
        seen.add(link["href"])
    return {"links": links, "problems": problems}


def _read_parts(parts):
    @F.arrow_udf(PAGE_TYPE)
    def read(html: pa.Array) -> pa.Array:
        return pa.array([read_page(h, parts) for h in html.to_pylist()], type=to_arrow_type(PAGE_TYPE))
    return read.asNondeterministic()


@F.arrow_udf(LINKS_TYPE)
def _read_links(html: pa.Array) -> pa.Array:
    return pa.array([read_links(h) for h in html.to_pylist()], type=to_arrow_type(LINKS_TYPE))


# These are said to be non-deterministic so that the planner calls them once per page, not once per field used.
_read_links = _read_links.asNondeterministic()


def read_pages(pages: DataFrame, parts=PARTS) -> DataFrame:
    """Pages with a ``page`` struct of raw texts, of some ``parts`` only if no others are wanted. Pages without any question
    are dropped before Python."""
    holds = F.contains("html", F.lit(ITEM_CLASS)) | F.contains("html", F.lit(BLOCK_CLASS))
    return pages.filter(holds).withColumn("page", _read_parts(tuple(parts))("html")).drop("html")


def page_errors(read: DataFrame) -> DataFrame:
    """(page_id, part, pos, message) for each part of a page that could not be read; the other parts are kept."""
    return read.select("page_id", F.inline("page.problems"))


# --- columns on the raw texts ----------------------------------------------------------------


def _labelled(label: str, field: str) -> Column:
    """Last info entry whose text holds the label, as the later ones overwrite the earlier."""
    fits = F.filter("q.info", lambda s: F.contains(s["label"], F.lit(label)) & s[field].isNotNull())
    return F.get(fits, F.size(fits) - 1)[field]


def option_text(options: str, letter: str) -> Column:
    """Text of the last option with this letter, null when there is none."""
    fits = F.filter(options, lambda o: o["letter"] == letter)
    return F.get(fits, F.size(fits) - 1)["text"]


def _correct_option(options: str) -> Column:
    return F.get(F.filter(options, lambda o: o["correct"]), F.lit(0))["letter"]


def extract_questions(read: DataFrame) -> DataFrame:
    """One row per question of the notebook pages. The page's answer key sits in the same row as its
    questions, so it is looked up in place, without a join."""
    each = read.select("page_id", "page.answers", F.posexplode("page.questions").alias("pos", "q"))
    own_key = F.filter("answers", lambda a: a["idx"] == F.col("q.idx"))
    year = F.trim(F.replace(_labelled("Ano:", "label"), F.lit("Ano:"), F.lit("")))
    return each.select(
        "page_id",
        F.col("pos").cast("long").alias("pos"),
        F.concat(F.lit("Q"), F.coalesce("q.qid", F.lit("N/A"))).alias("ID_Questao"),
        F.nullif("q.idx", F.lit("")).alias("Indice_Pagina"),
        year.alias("Ano"),
        _labelled("Banca:", "link").alias("Banca"),
        _labelled("Órgão:", "link").alias("Orgao"),
        _labelled("Prova:", "link").alias("Prova"),
        F.get("q.crumbs", F.lit(0)).alias("Disciplina"),
        F.get("q.crumbs", F.lit(1)).alias("Assunto"),
        F.col("q.statement").alias("Enunciado"),
        answer_of(F.get(own_key, F.size(own_key) - 1)["answer"], F.col("q.right_answer"),
                  _correct_option("q.options")).alias("Resposta_Correta"),
        F.filter("q.options", lambda o: o["letter"] != "").alias("options"),
    )


def extract_answer_key(read: DataFrame) -> DataFrame:
    """(page_id, idx, answer); a repeated index keeps its last answer."""
    last = F.filter("page.answers", lambda a: a["last"])
    return read.select("page_id", F.inline(last)).select("page_id", "idx", "answer")


def answer_of(key: Column, own: Column, marked: Column) -> Column:
    """Page key, else the question's own answer, else the option marked as correct."""
    given = [F.nullif(c, F.lit("N/A")) for c in (key, own, marked)]
    return F.coalesce(*given)


def resolve_answers(questions: DataFrame, key: DataFrame) -> DataFrame:
    """The same choice for questions and key kept in separate tables, joined on page and index."""
    joined = questions.join(key, ["page_id", "idx"], "left")
    answer = F.coalesce(answer_of(F.col("answer"), F.col("own"), F.col("marked")), F.lit("N/A"))
    return joined.withColumn("Resposta_Correta", answer).drop("answer", "own", "marked")


# --- mock exams ------------------------------------------------------------------------------

# Sentence patterns.
NUMBERED = r"(?s)^(\d+)[.\s]*(.*)"
WRONG_SENTENCE = r"(?is)marcou a resposta\s+(\w+).*?correta[^é]*é\s+([A-Z\d]+)"
RIGHT_SENTENCE = r"(?i)marcou a resposta\s+([A-Z\d]+)"


def _group(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def chosen_answer(sentence: Column) -> Column:
    return F.coalesce(_group(sentence, WRONG_SENTENCE, 1), _group(sentence, RIGHT_SENTENCE, 1))


def correct_answer(sentence: Column) -> Column:
    """The named correct answer, or the chosen one when the sentence names no other."""
    return F.coalesce(_group(sentence, WRONG_SENTENCE, 2), _group(sentence, RIGHT_SENTENCE, 1))


def tidy_comment(text: Column) -> Column:
    """Three or more line breaks become two."""
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def extract_mock_exam(read: DataFrame) -> DataFrame:
    """One row per answered question of the mock-exam pages."""
    each = read.select("page_id", F.posexplode("page.blocks").alias("pos", "b"))
    checked = F.col("b.checked")
    sentence = F.col("b.sentence")
    # True-or-false questions carry the letters C and E but are stored under their words.
    named = F.transform("b.options", lambda o: F.struct(
        F.when(o["letter"].isin("C", "E") & o["text"].isin("Certo", "Errado"), o["text"])
        .otherwise(o["letter"]).alias("letter"), o["text"].alias("text")))
    return each.select(
        "page_id",
        F.col("pos").cast("long").alias("pos"),
        _group(F.col("b.short"), NUMBERED, 1).alias("Numero_Questao"),
        F.when(F.contains("b.ok_text", F.lit("Certa")), "Certa")
        .when(F.contains("b.bad_text", F.lit("Errada")), "Errada").alias("Resultado"),
        F.coalesce("b.full", F.trim(F.regexp_extract("b.short", NUMBERED, 2))).alias("Enunciado"),
        F.coalesce(chosen_answer(sentence), checked).alias("Resposta_Marcada"),
        F.coalesce(correct_answer(sentence), checked).alias("Resposta_Correta"),
        tidy_comment(F.col("b.comment")).alias("Comentario_Professor"),
        F.filter(named, lambda o: o["letter"] != "").alias("options"),
    )


def widen_mock_exam(rows: DataFrame) -> DataFrame:
    """Mock-exam rows with a column for each option, N/A where a value is absent."""
    names = (*"ABCDE", "Certo", "Errado")
    wide = rows.withColumns({f"Alternativa_{n}": option_text("options", n) for n in names}).drop("options")
    return wide.select(*[F.coalesce(c, F.lit("N/A")).alias(c) if t == "string" else F.col(c) for c, t in wide.dtypes])


# --- links -----------------------------------------------------------------------------------

# Link patterns.
MOCK_LINKS = ("/simulados/", "/provas/", "/practice-tests/", "simulado")
NOTEBOOK_LINK = "/questoes-de-concursos/questoes?notebook_ids"
NOTEBOOK_ID = r"notebook_ids%5B%5D=(\d+)"
NOTEBOOK_SIZE = r"(\d+)\s+questões"


def read_anchors(pages: DataFrame) -> DataFrame:
    """Pages with the links read from their tags in ``read``; pages without a link are dropped before Python."""
    return pages.filter(F.contains(F.lower("html"), F.lit("<a"))).withColumn("read", _read_links("html")).drop("html")


def page_anchors(pages: DataFrame) -> DataFrame:
    """(page_id, pos, href, name) for every link of every page; a link without text is named by its address."""
    each = read_anchors(pages).select("page_id", F.posexplode("read.links").alias("pos", "a"))
    return each.select("page_id", F.col("pos").cast("long").alias("pos"), F.col("a.href").alias("href"),
                       F.coalesce(F.nullif("a.name", F.lit("")), "a.href").alias("name"))


def mock_links(pages: DataFrame, patterns=MOCK_LINKS) -> DataFrame:
    """Links that fit one of the patterns, each address once per page, with the first pattern it fits."""
    numbered = F.transform("read.links", lambda a, i: F.struct(
        a["href"].alias("href"),
        F.coalesce(*[F.when(F.contains(a["href"], F.lit(p)), n) for n, p in enumerate(patterns, 1)]).cast("long")
        .alias("priority"),
        i.cast("long").alias("pos"), F.coalesce(F.nullif(a["name"], F.lit("")), a["href"]).alias("name"),
        a["first"].alias("first")))
    wanted = F.filter(numbered, lambda a: a["first"] & a["priority"].isNotNull())
    return read_anchors(pages).select("page_id", F.inline(wanted)).drop("first")


def notebook_links(pages: DataFrame) -> DataFrame:
    """(id, name, href, questions) of the notebooks linked from pages; the first link of an id stays. The number of
    questions stands in the card around a link, and is N/A without one."""
    some = pages.filter(F.contains("html", F.lit("notebook_ids")))
    each = read_anchors(some).select("page_id", F.posexplode("read.links").alias("pos", "a"))
    found = each.select(
        "page_id", "pos", _group(F.col("a.href"), NOTEBOOK_ID, 1).alias("id"), F.col("a.name").alias("name"),
        F.col("a.href").alias("href"),
        F.coalesce(_group(F.col("a.subtitle"), NOTEBOOK_SIZE, 1), F.lit("N/A")).alias("questions"),
    ).filter(F.col("id").isNotNull() & F.contains("href", F.lit(NOTEBOOK_LINK)))
    first = F.min_by(F.struct("name", "href", "questions"), F.struct("page_id", "pos")).alias("first")
    return found.groupBy("id").agg(first).select("id", "first.*")

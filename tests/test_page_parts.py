"""Pages made from the rows of a small table are read by many tasks."""

import pytest

from tallybank.operators import pages
from tallybank.operators.pages import read_page
from tallybank.plans import adapters as D
from tallybank.session import INPUT_PARTITIONS


@pytest.mark.parametrize("made", [D.broken_pages, D.notebook_pages, D.link_pages, D.chained_pages])
def test_pages_are_dealt_out_whatever_the_size_of_the_file(spark, small, made):
    held = spark.conf.get(INPUT_PARTITIONS)
    spark.conf.unset(INPUT_PARTITIONS)
    try:
        pages = made(spark, small)
        assert pages.rdd.getNumPartitions() >= D.PAGE_PARTS
        assert pages.count() == D.table(spark, small, "customer").count()
    finally:
        spark.conf.set(INPUT_PARTITIONS, held)


def test_answers_alone_are_read_as_with_the_other_parts(monkeypatch):
    html = ('<div class="js-question-item"><span class="q-index">1</span></div><fieldset class="q-questions-feedback"><div class="q-feedback">'
            '<span class="q-index">1:</span><span class="q-answer">A</span></div></fieldset>')
    whole = read_page(html)
    assert whole["questions"] and read_page(html, ("answers",)) == whole | {"questions": [], "blocks": []}
    monkeypatch.setattr(pages, "_question", lambda item: 1 / 0)  # not called for answers
    assert read_page(html, ("answers",))["problems"] == []

"""Counts by template read scenes in one pass, in threads that each name relations of their own."""

from posegrid.operators import recipe

SF = "/root/testdata/sf0.001"


def test_templates_name_the_scenes_relations(spark, monkeypatch):
    texts, plain = [], recipe.query
    monkeypatch.setattr(recipe, "query", lambda spark, text: texts.append(text) or plain(spark, text))
    text = "select ord, count(*) as n from question_leads group by 1"
    counts = dict(map(tuple, recipe.each_template(spark, SF, text, "counted").collect()))
    assert sum("drawn_triples_" in t for t in texts) == 2 and sum("drawn_objects_" in t for t in texts) == 3
    assert len(counts) >= 14 and min(counts.values()) > 0


def test_counting_draws_no_options():
    """Each template's rows are counted by what makes them a row: no options, no wording."""
    from posegrid.functions.dialect import Spark
    from posegrid.plans import questions

    d = Spark(SF)
    texts, leads = questions.count_texts(d), questions.lead_texts(d)
    assert len(texts) == len(leads) == len(recipe.TEMPLATES)
    assert all("of_w" not in t and "array_sort" not in t and "Take {A}" not in t for t in texts)


def test_counts_are_those_of_the_leads(spark):
    text = "select question_type, sub_question_type, count(*) as n from question_leads group by 1, 2"
    want = sorted(map(tuple, recipe.each_template(spark, SF, text, "leads").collect()))
    assert sorted(map(tuple, recipe.template_counts(spark, SF).collect())) == want and len(want) > 15

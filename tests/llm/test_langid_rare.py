"""A rare language has a model, at any size of the table."""

from basketry.llm import langid

RARE = "это дом и вот такая вещь там где мы были"


def test_rare_languages_are_known(docs_of):
    rows = [(i, "the house and this thing", "en", "s", 1) for i in range(600)]
    rows += [(1000 + i, "dans une maison avec cela", "fr", "s", 1) for i in range(300)]
    rows += [(2000 + i, RARE, f"r{i}", "s", 1) for i in range(8)] + [(None, RARE, "ru", "s", 1)]
    model = langid.fit(docs_of(rows), most=40)
    assert model.classes == sorted({r[2] for r in rows}) + ["und"]


def test_its_texts_are_accepted(docs_of):
    rows = [(i, "the house and this thing with that there", "en", "s", 1) for i in range(6000)]
    rows += [(9000 + i, RARE, "ru", "s", 1) for i in range(2)]
    docs = docs_of(rows)
    found = langid.identify_documents(docs, langid.fit(docs)).where("lang = 'ru'").collect()
    assert [(r.language.lang, r.language.accepted) for r in found] == [("ru", True)] * 2


def test_languages_beyond_the_limit_share_a_model(docs_of):
    rows = [(i, "the house and this thing with that there", "en", "s", 1) for i in range(60)]
    rows += [(1000 + i, RARE, "ru", "t", 1) for i in range(9)]
    rows += [(2000 + i, "bu ev ve şu şey orada bizim olduğumuz", "tr", "t", 1) for i in range(8)]
    rows += [(3000, RARE, None, "t", 1)]
    docs = docs_of(rows)
    model = langid.fit(docs, languages=1)
    assert model.classes == ["en", langid.MIS, "und"] and model.shared
    found = {r.doc_id: r.language for r in langid.identify_documents(docs, model).collect()}
    assert {i: x.lang for i, x in found.items()} == {r[0]: r[2] or langid.MIS for r in rows}
    assert all(x.accepted for x in found.values())
    assert langid.fit(docs, languages=3).classes == ["en", "ru", "tr", "und"]

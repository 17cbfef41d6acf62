"""The training sample stays off the driver, and the model does not depend on where it is fitted."""

import numpy as np

from corpusmill.llm import langid


def test_only_the_model_reaches_the_driver(spark, monkeypatch):
    said = {"en": "the house and the river {} stood by a road", "de": "das Haus und der Fluss {} lagen an einer Straße", "fr": "la maison et la rivière {} près de la route"}
    docs = spark.createDataFrame([(i, text.format(i), lang) for k, (lang, text) in enumerate(said.items()) for i in range(k * 200, k * 200 + 200)], "doc_id long, text string, lang string")
    kind, largest = type(docs), []
    collect = kind.collect

    def watched(self):
        rows = collect(self)
        largest.append(len(rows))
        return rows

    monkeypatch.setattr(kind, "collect", watched)
    model = langid.train(docs.repartition(3))
    monkeypatch.undo()
    assert largest and max(largest) <= len(said)  # languages and their counts, and the model
    known = docs.where(~langid.held_out(docs.doc_id)).collect()
    same = langid.fit([(r.lang, langid.packed(langid.features(r.text))) for r in sorted(known, key=lambda r: (r.lang, str(r.doc_id)))])
    assert model.languages == same.languages == ["de", "en", "fr"]
    assert all(np.array_equal(a, b) for a, b in zip(model[1:], same[1:], strict=True))
    assert [langid.decode(model, t.format("x"))[0] for t in said.values()] == list(said)

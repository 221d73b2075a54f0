from docrecords.llm import substrings as sub
from tests.llm.test_substrings import prose


def test_texts_of_one_id_are_documents_of_their_own(spark):
    passage = prose(1, 80)
    texts = [passage + " " + prose(2, 300), prose(3, 20) + " " + passage, prose(4, 30), passage]
    docs = spark.createDataFrame([(5, t) for t in texts] + [(5, texts[0])], "doc_id long, text string")
    spans = sub.repeated_spans(docs).collect()
    assert len(spans) == len({r.version for r in spans}) == 2 and {r.place for r in spans} == {5}
    got = [r.text for r in sub.remove_repeats(docs).collect()]
    assert len(got) == 5 and prose(4, 30) in got
    whole = [t for t in got if passage in t]
    assert len(set(whole)) == 1
    # What stays is everything but the passage, to within a chunk or two at its ends.
    lost = sum(map(len, set(texts))) - sum(map(len, set(got)))
    assert 2 * (len(passage) - 150) <= lost <= 2 * (len(passage) + 2)
    assert sum(prose(2, 300) in t for t in got) == 2 and sum(prose(3, 20) in t for t in got) == 1

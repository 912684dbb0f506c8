from cases import documents, edge_texts, empty, words

from winnow.llm import decontaminate as D

QUESTION = ("A shop sells apples in boxes. Yesterday morning Anna packed 12 boxes of 5 kg each and then Anna sold 7 boxes "
            "to her neighbour for 30 dollars. How many boxes does Anna still have today?")
CHANGED = QUESTION.replace("Anna", "Peter").replace("12", "48").replace("5 kg", "9 pounds").replace("30", "95")
MIXED = QUESTION.replace("Anna packed 12", "Peter packed 48").replace("then Anna sold 7", "then Olga sold 12").replace(
    "does Anna", "does Ivan").replace("5 kg", "12 kg").replace("30 dollars", "12 euros")
TEXTS = edge_texts() + [words(11, 300) + ".\n" + QUESTION + "\n" + words(12, 300), words(13, 200) + ". " + CHANGED, MIXED, QUESTION.upper(),
                        QUESTION[: len(QUESTION) // 5], QUESTION.replace("morning", "evening").replace("neighbour", "brother")]


def bench(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "item_id long, text string")


def test_leaks(spark):
    items = [QUESTION, words(21, 40), None, "", "short one", words(2, 30)]
    got = {(r["doc_id"], r["item_id"]): r for r in D.leaks(documents(spark, TEXTS), bench(spark, items)).collect()}
    assert set(got) == {(10, 0), (11, 0), (13, 0), (15, 0), (7, 5)}
    assert got[10, 0]["kind"] == "same" and got[11, 0]["kind"] == "changed" and got[11, 0]["n_slots"] > 5
    assert got[11, 0]["consistent"] == 1.0 and got[10, 0]["covered"] > 0.9


def test_matches_a_plain_search(spark):
    """Every placed item is found and nothing else: exact windows, no slots."""
    items = [words(100 + i, 15 + i) for i in range(20)]
    texts = [words(500 + i, 100) + " " + items[i % 20] + " " + words(700 + i, 50) if i % 3 else words(900 + i, 200) for i in range(60)]
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(documents(spark, texts), bench(spark, items)).collect()}
    assert got == {(i, i % 20) for i in range(60) if i % 3}


def test_blocks_of_the_benchmark(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_WINDOWS", 300)
    docs, items = documents(spark, TEXTS), bench(spark, [QUESTION, words(2, 30), QUESTION])
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, items).collect()}
    assert got == {(d, i) for d in (10, 11, 13, 15) for i in (0, 2)} | {(7, 1)}
    kept = D.clean(docs, items)
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(TEXTS))) - {7, 10, 11, 13, 15} and kept.columns == docs.columns


def test_empty(spark):
    assert D.leaks(empty(spark), bench(spark, [QUESTION])).count() == 0
    assert D.leaks(documents(spark, TEXTS), bench(spark, [])).count() == 0
    assert D.clean(documents(spark, TEXTS), bench(spark, [])).count() == len(TEXTS)


def test_changed_numbers_and_every_place(spark):
    item = "In the yard there are 3 boxes and on the old table lie 4 apples for the children to eat"
    twice = "The farmer sold 5 sheep to his brother and then 5 goats to the old miller and kept 2 horses"
    texts = [item.replace("3", "5").replace("4", "5"), twice.replace("5 sheep", "7 sheep").replace("5 goats", "9 goats"),
             MIXED + " " + MIXED + " " + words(31, 200) + ". " + CHANGED]
    got = {(r["doc_id"], r["item_id"]): r for r in D.leaks(documents(spark, texts), bench(spark, [item, twice, QUESTION])).collect()}
    assert set(got) == {(0, 0), (1, 1), (2, 2)} and {r["kind"] for r in got.values()} == {"changed"}


def test_items_of_numbers_and_names(spark):
    items = ["Compute 12 + 34 - 56", "Anna Smith met Peter Jones in Paris", " ".join(str(i * i) for i in range(30)), "12 34"]
    texts = [words(41, 50) + ". " + x + " " + words(42, 50) for x in items]
    texts += [texts[0].replace("34", "35"), texts[1].replace("Smith", "Brown"), " ".join(str(i * i) for i in range(25))]
    got = {(r["doc_id"], r["item_id"], r["kind"]) for r in D.leaks(documents(spark, texts), bench(spark, items)).collect()}
    assert got == {(i, i, "same") for i in range(3)}


def test_item_ids_of_text_and_accented_names(spark):
    items = spark.createDataFrame([("q-1", QUESTION), ("q-é", "In the old house Émile gave 3 red apples to his friend Óscar before the long walk home")], "item_id string, text string")
    renamed = "In the old house Álvaro gave 5 red apples to his friend Zoë before the long walk home"
    got = {(r["doc_id"], r["item_id"], r["kind"]) for r in D.leaks(documents(spark, [CHANGED, renamed, words(3, 40)]), items).collect()}
    assert got == {(0, "q-1", "changed"), (1, "q-é", "changed")}
    assert {r["doc_id"] for r in D.clean(documents(spark, [CHANGED, renamed, words(3, 40)]), items).collect()} == {2}

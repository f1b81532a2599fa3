"""Leaks: copies, re-parameterised questions, inconsistent slots, odd rows."""

from tidelog.llm.decontaminate import find_leaks

QUESTION = "If Anna buys 12 apples for 3 dollars each and then gives Bert 12 of the apples, how much did Anna pay in all?"
OTHER = "The train to the coast leaves when the morning bell rings and the last of the porters has left the yard"
FILLER = "some words that have nothing to do with any of it and go on for quite a while before and after the rest"


def leaks(frame, docs, items):
    items = frame(items, clash=False).withColumnRenamed("doc_id", "item_id")
    return {(r["doc_id"], r["item_id"]): r for r in find_leaks(frame(docs), items).collect()}


def test_copies_and_new_parameters(frame):
    changed = QUESTION.replace("Anna", "Clara").replace("Bert", "Dora").replace("12", "7").replace(" 3 ", " 45 ")
    uneven = QUESTION.replace("gives Bert 12", "gives Bert 99")
    docs = [
        (1, f"{FILLER} {QUESTION} {FILLER}"),
        (2, f"{FILLER}. {changed} {FILLER}"),
        (3, f"{FILLER} {uneven} {FILLER}"),
        (4, FILLER),
        (5, f"{OTHER.upper()} {FILLER}"),
        (6, " ".join(QUESTION.split()[:9]) + " " + FILLER),
    ]
    found = leaks(frame, docs, [(10, QUESTION), (11, OTHER), (12, QUESTION), (13, None), (14, ""), (15, "?!")])
    assert set(found) == {(1, 10), (1, 12), (2, 10), (2, 12), (5, 11)}
    assert found[1, 10]["same_slots"] and not found[2, 10]["same_slots"]
    assert found[2, 10]["share"] > 0.6 and found[1, 10]["n_windows"] >= 10


def test_short_items_and_letters_beyond_ascii(frame):
    docs = [(1, "vorher ÜBER ÖDE ÄCKER danach"), (2, "über öde wiesen"), (3, "x 5 kg of flour please")]
    found = leaks(frame, docs, [(1, "Über öde äcker."), (2, "take 7 kg of flour")])
    assert set(found) == {(1, 1)}


def test_odd_rows(frame, corpus):
    items = [(1, corpus[0][1]), (None, corpus[5][1]), (2, None)]
    found = leaks(frame, corpus, items)
    assert (0, 1) in found
    assert leaks(frame, [], items) == {} and leaks(frame, corpus, []) == {}


def many(n, start=0):
    """Words that occur once, without numbers and names."""
    return [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(start, start + n)]


def test_inserted_words_and_longer_names_part_no_alignment(frame):
    item = many(20)
    put = item[:7] + ["really"] + item[7:14] + ["very"] + item[14:]
    named = "the farmer called Anna went out to the field and then told Bert that rain would come before dark"
    longer = named.replace("Anna", "Clara Maria").replace("Bert", "Dora Lena Ruth")
    half = " ".join(many(38)[:19] + ["new"] + many(38)[19:])
    docs = [(1, " ".join(item[:10] + ["x"] + item[10:])), (2, f"{FILLER} {longer} {FILLER}"), (3, half), (4, " ".join(put))]
    items = [(1, " ".join(item[:15])), (2, named), (3, " ".join(many(38))), (4, " ".join(item))]
    found = leaks(frame, docs, items)
    assert {(1, 4), (2, 2), (3, 3)} <= set(found)
    assert found[3, 3]["share"] > 0.7 and found[2, 2]["share"] > 0.9


def test_one_altered_number_and_merged_values_are_still_found(frame):
    text = many(60)
    text[10] = text[40] = "12"
    altered = text[:40] + ["13"] + text[41:]
    merged = "she put 3 red stones and then 5 blue ones in the old box under the bed"
    docs = [(1, " ".join(altered)), (2, merged.replace("3", "4").replace("5", "4"))]
    found = leaks(frame, docs, [(1, " ".join(text)), (2, merged)])
    assert set(found) == {(1, 1), (2, 2)}
    assert 0.6 < found[1, 1]["share"] < 1 and not found[1, 1]["same_slots"]


def test_dense_items_opening_names_and_long_units(frame):
    asked = "Anna has 12 apples. Bert has 7 pears. Carla buys 3 of them for 2 dollars. How many does Carla have?"
    new = asked.replace("Anna", "Dora").replace("Bert", "Emil").replace("Carla", "Frida")
    names = "Anna, Bert, Carla, Dora, Emil, Frida, Gustav, Hanna, Ida, Jonas"
    way = "they walked 5 kilometres along the river and carried 3 kilograms of salt up the steep hill"
    units = way.replace("kilometres", "metres").replace("kilograms", "grams")
    docs = [(1, f"{FILLER}. {new}"), (2, f"{FILLER} 5 + 7 = 12 {FILLER}"), (3, f"so: {names}"), (4, units), (5, "6 + 7 = 12")]
    found = leaks(frame, docs, [(1, asked), (2, "5 + 7 = 12"), (3, names), (4, way)])
    assert set(found) == {(1, 1), (2, 2), (3, 3), (4, 4)}

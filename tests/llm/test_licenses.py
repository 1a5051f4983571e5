import random
import re
from itertools import combinations

import pytest

from modelyard.llm.licenses import LEAST_COVER, MAX_GAP, PHRASES, TEMPLATES, license_spans, license_words, op9_license_chains, scanner


def holds(words, part):
    return any(words[i : i + len(part)] == part for i in range(len(words) - len(part) + 1))


def test_matching_statistics_equal_brute_force():
    pick, tool = random.Random(2), scanner()
    every = sorted({w for words in tool.lists for w in words})
    phrases = [p.encode().split() for p in PHRASES]
    for _ in range(60):
        words = []
        while len(words) < 25:
            words_of = pick.choice(tool.lists)
            at = pick.randrange(len(words_of))
            words += words_of[at : at + pick.randint(1, 9)] if pick.random() < 0.6 else [b"zz", pick.choice(every)]
        places, runs = tool.statistics(words)
        assert sorted(places) == sorted(
            (k, i) for k, p in enumerate(phrases) for i in range(len(words)) if words[i : i + len(p)] == p
        )
        for start, end, _ in runs:  # each run is in a template and cannot be longer on either side
            assert any(holds(x, words[start:end]) for x in tool.lists)
            assert start == 0 or not any(holds(x, words[start - 1 : end]) for x in tool.lists)
            assert end == len(words) or not any(holds(x, words[start : end + 1]) for x in tool.lists)


def test_chains_bridge_changed_words():
    tool = scanner()
    words = license_words(TEMPLATES["mit"])
    changed = words[:20] + [b"changed"] + words[21:50] + words[53:]
    [(share, number, start, end)], largest = tool.chains(tool.statistics(changed)[1])
    assert share == largest and tool.labels[number] == "mit" and (start, end) == (0, len(changed)) and 0.9 < share < 1
    half = words[: len(words) // 3]
    assert not tool.scan(b" ".join(half).decode())[2]


@pytest.mark.parametrize("label", list(TEMPLATES))
def test_every_template_is_found_with_every_ninth_word_changed(label):
    words = license_words(TEMPLATES[label])
    changed = [b"changed" if at % 9 == 8 else word for at, word in enumerate(words)]
    chains = scanner().scan(b" ".join(changed).decode())[2]
    assert [scanner().labels[c[1]] for c in chains] == [label] and chains[0][0] > 0.8


def test_a_notice_keeps_its_label_beside_its_own_words():
    """Words of the notice's beginning, in its middle, neither end the chain nor take its place."""
    words = license_words(TEMPLATES["mit"])
    changed = words[:50] + words[10:15] + words[53:]
    [(share, number, start, end)] = scanner().scan(b" ".join(changed).decode())[2]
    assert scanner().labels[number] == "mit" and (start, end) == (0, len(changed)) and share > 0.9


def test_each_notice_of_a_text_is_a_span():
    notice = TEMPLATES["apache"]
    n = len(license_words(notice))
    for between in ("", "int main ( void )", "x " * 100):
        gap = len(license_words(between))
        chains = scanner().scan(f"{notice} {between} {notice} {between} {notice}")[2]
        assert [(c[2], c[3]) for c in chains] == [(k * (n + gap), k * (n + gap) + n) for k in range(3)]


def test_chains_equal_all_sequences_of_runs():
    """Best chains against every sequence of runs, choices against every set of chains."""
    pick, tool = random.Random(5), scanner()
    for _ in range(40):
        words = []
        for _ in range(pick.randint(2, 6)):
            part = tool.lists[pick.choice([5, 9])]
            at = pick.randrange(len(part) - 4)
            words += part[at : at + pick.randint(4, 40)] + [b"zz"] * pick.choice([0, 1, 20, 35])
        runs = tool.statistics(words)[1]
        places: dict = {}
        for start, end, state in runs:
            for number, to in tool.automaton.ends[state]:
                if number >= tool.phrases:
                    places.setdefault(number, []).append((start, end, to))
        ended = tool.best_chains(runs)
        assert ended.keys() == places.keys()
        want = []
        for number, nodes in places.items():

            def sequences(i):
                start, end, to = nodes[i]
                yield end - start, start
                for j, (a, b, before) in enumerate(nodes[:i]):
                    if a < start and start - b <= MAX_GAP and before < to and to - (end - start) - before <= MAX_GAP:
                        for covered, first in sequences(j):
                            yield covered + min(end - start, to - before, end - b), first

            best = [(*max(sequences(i)), nodes[i][1]) for i in range(len(nodes))]
            assert ended[number] == best
            shares = [(min(1.0, c / len(tool.lists[number])), a, b) for c, a, b in best]
            shares = [x for x in shares if x[0] >= LEAST_COVER]
            sets = [c for k in range(4) for c in combinations(shares, k) if all(x[2] <= y[1] for x, y in zip(c, c[1:]))]
            want.append(max(sum(x[0] ** 2 for x in c) for c in sets))
        chains, _ = tool.chains(runs)
        assert sum(c[0] ** 2 for c in chains) == pytest.approx(sum(want))


def test_labels_of_the_method_come_on_top():
    tool = scanner()
    n, places, chains, _ = tool.scan("x " + TEMPLATES["bsd"] + " under the MIT License.")
    assert [tool.labels[p] for p, _ in places] == ["mit"] and [tool.labels[c[1]] for c in chains] == ["bsd"]


def test_edges(spark):
    long = "word " * 50000 + "Apache-License"
    rows = [(1, None, 1), (2, "", 1), (None, "CC BY", 1), (3, "CC by, cc-BY", 1), (3, "CC by, cc-BY", 1), (4, long, 1), (5, "ccby ÄCC BY", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label long")
    found = sorted(((r.doc_id or 0), [(s.label, s.first_word) for s in r.spans]) for r in license_spans(docs).collect())
    assert found == [
        (0, [("cc-by", 0)]), (1, []), (2, []), (3, [("cc-by", 0), ("cc-by", 2)]), (3, [("cc-by", 0), ("cc-by", 2)]),
        (4, [("apache", 50000)]), (5, []),
    ]
    assert license_spans(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op9_license_chains(spark, folder).collect()
    assert len(rows) == len(texts) and any(r.n_base for r in rows)
    for r in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        want = [(i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in want]
        assert (r.n_words, r.n_base) == (len(words), len(want))
        assert (r.first_word, r.last_word) == ((min(at), max(at)) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in want}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_general_public_license_needs_its_gnu(spark, tmp_path):
    rows = [(1, "the GNU General Public License"), (2, "a general public license, gnu"), (3, "GNU Lesser General Public License")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in op9_license_chains(spark, str(tmp_path)).collect()}
    assert found == {1: (5, 1, 1, 1, "gpl"), 2: (5, 0, None, None, ""), 3: (5, 0, None, None, "")}

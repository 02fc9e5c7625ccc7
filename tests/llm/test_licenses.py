import random
import re

from loomspan.llm import licenses as lc


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_base(text):
    ws = words(text)
    hits = [(i, label) for phrase, label in lc.PHRASES.items() for i in range(len(ws)) if ws[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in hits]
    return len(ws), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in hits}))


def plain_labels(text, config=lc.ScanConfig()):
    """{label: best share} of verified notices, by comparing all places."""
    ws, found, k = words(text), {}, config.k
    for label, notice in lc.NOTICES:
        ns = words(notice)
        votes = {}
        for p in range(len(ws) - k + 1):
            for t in range(len(ns) - k + 1):
                if ws[p : p + k] == ns[t : t + k]:
                    votes.setdefault(p - t, set()).add(p)
        spans, last = [], None
        for d in sorted(votes):
            if last is None or d - last > config.shift:
                spans.append([])
            spans[-1].append(d)
            last = d
        for span in spans:
            if sum(len(votes[d]) for d in span) >= config.least_votes * (len(ns) - k + 1):
                share = sum(any(0 <= i + d < len(ws) and ws[i + d] == n for d in span) for i, n in enumerate(ns)) / len(ns)
                if share >= config.least_words:
                    found[label] = max(found.get(label, 0), share)
    return found


def check(got, rows):
    texts = {i: t for i, t, *_ in rows}
    assert len(got) == len(rows)
    for r in got:
        base, more = plain_base(texts[r.doc_id]), plain_labels(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base
        assert r.labels == ",".join(sorted({*more, *filter(None, base[4].split(","))}))
        assert r.score == (1.0 if base[1] else round(max(more.values(), default=0.0), 9))


def planted(seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(120):
        body = [rng.choice(["code", "text", "Lizenz", "é", "the", "license", "under", "cc", "by"]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            notice = words(rng.choice(lc.NOTICES)[1])
            for _ in range(rng.randint(0, len(notice) // 5)):  # words lost, replaced and put in
                at = rng.randrange(len(notice))
                notice[at : at + rng.randint(0, 1)] = rng.choice([[], ["other"], ["two", "more"]])
            at = rng.randint(0, len(body))
            body[at:at] = notice
        rows.append((i, rng.choice([" ", "\n", ", "]).join(body)))
    return rows


def test_against_plain_search(spark, docs, rows):
    check(lc.scan(docs).collect(), [r[:2] for r in rows])


def test_edited_notices_against_plain_search(spark):
    rows = planted()
    found = lc.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    check(found, rows)
    assert sum("apache" in r.labels for r in found) > 5 and sum(0 < r.score < 1 for r in found) > 5


def test_spans_are_where_the_notice_stands(spark):
    text = "a b " + lc.NOTICES[-1][1] + " c " * 50 + "Released under the MIT License."
    got = {(r.label, r.start, r.end, r.share) for r in lc.spans(spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")).collect()}
    n = len(words(lc.NOTICES[-1][1]))
    assert got == {("mpl-2.0", 2, 2 + n, 1.0), ("mit", 2 + n + 50, 2 + n + 55, 1.0)}


def test_nulls_repeats_empty_and_long(spark, empty):
    long = "All rights reserved. " + "wort straße " * 200_000 + "licensed under CC BY-NC 4.0"
    rows = [(1, None), (2, ""), (3, " .,\x00 "), (4, "cc by"), (5, "cc by cc by"), (6, long)]
    twice = [(7, "Released under the MIT license"), (7, "Released under the MIT license"), (None, "Released under the MIT license")]
    got = lc.scan(spark.createDataFrame(rows + twice, "doc_id long, text string")).collect()
    check([r for r in got if r.doc_id not in (7, None)], rows)
    assert [(r.labels, r.score, r.n_base, r.first_word) for r in got if r.doc_id in (7, None)] == [("mit", 1.0, 0, None)] * 3
    assert lc.scan(empty).count() == 0

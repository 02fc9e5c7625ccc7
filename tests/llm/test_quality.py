from collections import Counter, defaultdict

from pyspark.sql import functions as F

from loomspan.llm.quality import LineLimits, apply_rules, base_figures, remove_rejected


def brute(rows, limits):
    lines, hosts = defaultdict(set), defaultdict(set)
    norm = lambda t: [x for x in (" ".join(raw.lower().split()) for raw in t.split("\n")) if x]
    for r in rows:
        if r[1] is not None and norm(r[1]):
            hosts[r[3]].add(r[1])
            for x in norm(r[1]):
                lines[r[3], x].add(r[1])
    bad = {k for k, v in lines.items() if len(v) >= limits.min_docs and len(v) > limits.max_share * len(hosts[k[0]])}
    out = []
    for r in rows:
        w = (r[1] or "").encode().split()
        lost = sum(len(x.split(" ")) for x in norm(r[1] or "") if (r[3], x) in bad)
        tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        seen = Counter(tri)
        cover = {i + j for i, t in enumerate(tri) if seen[t] > 1 for j in range(3)}
        failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        out.append((r[0], len(w), len(cover), failed, lost, not failed and len(w) - lost >= limits.min_left * len(w)))
    return sorted(out, key=str)


def test_rules_match_brute_force(docs, rows, repeated):
    limits = LineLimits(min_docs=3, max_share=0.01, min_left=0.6)
    got = apply_rules(docs, limits).select("doc_id", "n_words", "n_repeat_words", "base_failed", "n_line_words", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, limits)
    again = repeated.select("*").collect()
    got = apply_rules(repeated, limits).select("doc_id", "n_words", "n_repeat_words", "base_failed", "n_line_words", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute([tuple(r) for r in again], limits)


def test_base_figures_by_hand():
    assert base_figures(None) == base_figures("") == (0, 0, 0, 0, 0)
    assert base_figures("a b\n\nx\n\na b\n a b") == (7, 7, 0, 1, 0)
    assert base_figures("a b c a b c #") == (7, 7, 1, 0, 6)


def test_empty_and_filter(docs, empty):
    assert apply_rules(empty).count() == 0 and remove_rejected(empty).count() == 0
    kept = {r["doc_id"] for r in apply_rules(docs).filter("kept").collect()}
    out = remove_rejected(docs)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == kept
    assert out.filter(F.col("hits") != "x").count() == 0

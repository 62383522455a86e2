import re
from collections import Counter, defaultdict

import cases
from tidewatch.llm.line_frequency import quality_filter, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LIMITS = {"max_docs": 2, "least_share": 0.5}


def counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), sum(c in "[#*$%&|<>]"[1:-1] for c in text or ""), dup,
        len(covered),
    )


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else c for c in text)


def lines(text):
    out = Counter()
    for line in (text or "").split("\n"):
        words = WORD.findall(lower(line))
        if words:
            out[tuple(words)] += len(words)
    return out


def brute(rows):
    holders = defaultdict(set)
    for r in rows:
        for line in lines(r.text):
            holders[r.source or "", line].add(r.text or "")
    out = []
    for r in rows:
        c = counts(r.text)
        removed = sum(
            n for line, n in lines(r.text).items()
            if len(holders[r.source or "", line]) > LIMITS["max_docs"]
        )
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        kept = not failed and c[0] - removed >= LIMITS["least_share"] * c[0]
        out.append((r.doc_id, *c, removed, failed, kept))
    return out


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_against_brute_force(spark):
    docs = cases.documents(spark)
    got = quality_rules(docs, **LIMITS).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "removed_words", "base_failed", "kept",
    )
    wanted = brute(docs.collect())
    assert sorted(map(tuple, got.collect()), key=key) == sorted(wanted, key=key)
    assert any(w[-3] for w in wanted) and any(w[-1] for w in wanted)


def test_filter_keeps_whole_rows(spark):
    docs = cases.documents(spark)
    rows = docs.collect()
    wanted = [tuple(r) for r, v in zip(rows, brute(rows), strict=True) if v[-1]]
    got = quality_filter(docs, **LIMITS)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(wanted, key=repr)


def own(*names, k=12):
    return " ".join(f"{''.join(chr(97 + int(c)) for c in str(n))}{chr(97 + j)}" for n in names for j in range(k))


def test_scaling_the_table_keeps_the_verdicts(spark):
    notice = "this line stands in a tenth of all documents of its host and nowhere else at all"
    verdicts = []
    for size in (100, 1000):
        texts = [notice if k == 0 else f"{own(k)}\n{notice}" if k % 10 == 0 else own(k) for k in range(size)]
        docs = cases.documents(spark, list(enumerate(texts))).drop("source")
        rows = quality_rules(docs.selectExpr("*", "'one' as source")).collect()
        verdicts.append({r.doc_id: (r.removed_words > 0, r.kept) for r in rows if r.doc_id < 100})
    assert verdicts[0] == verdicts[1]
    assert verdicts[0][0] == (True, False) and verdicts[0][10] == (True, True) and verdicts[0][1] == (False, True)


def test_near_copies_do_not_remove_each_other(spark):
    lines = [own(9000 + k) for k in range(10)]
    rows = [(k, own(k)) for k in range(60)]
    for k in range(200):  # each has another line changed
        rows.append((100 + k, "\n".join(own(500 + k, k=6) if j == k % 10 else x for j, x in enumerate(lines))))
    docs = cases.documents(spark, rows).drop("source").selectExpr("*", "'one' as source")
    kept = {r.doc_id for r in quality_rules(docs).collect() if r.kept}
    assert kept == {r[0] for r in rows}


def test_pages_of_one_common_line_are_rejected(spark):
    notice = own(7777, 7778)  # 24 words
    rows = [(k, own(k, k + 1000)) for k in range(70)]
    rows += [(100 + k, f"{notice}\n{own(5000 + k, k=3)}") for k in range(30)]
    longer = [(200 + k, f"{notice}\n{own(*range(6000 + 10 * k, 6008 + 10 * k))}") for k in range(5)]
    for extra in ([], longer):
        docs = cases.documents(spark, rows + extra).drop("source").selectExpr("*", "'one' as source")
        kept = {r.doc_id for r in quality_rules(docs).collect() if r.kept}
        assert kept == {k for k in range(70)} | {k for k, _ in extra}


def brute_shares(texts, max_share=0.05, least_docs=5, least_share=0.2):
    """Words removed from each of a host's distinct texts, by the rule of the registered query."""
    held = {t: lines(t) for t in texts}
    holders = Counter(line for t in held for line in held[t])
    alike = defaultdict(set)
    for t, own_lines in held.items():
        often = [x for x in own_lines if holders[x] > max(least_docs, max_share * len(held))]
        n_words = sum(own_lines.values())
        if n_words - sum(own_lines[x] for x in often) < least_share * n_words:
            top = sorted(often, key=lambda x: -own_lines[x])[:3]
            for pair in {frozenset((x, y)) for x in top for y in top if x != y}:
                alike[pair].add(t)
    weight = {t: 1.0 for t in held}
    for group in alike.values():
        for t in group:
            weight[t] = min(weight[t], 1 / len(group))
    size = sum(weight.values())
    own_count = {x: round(sum(weight[t] for t in held if x in held[t]), 6) for x in holders}
    gone = {x for x in holders if holders[x] > least_docs and own_count[x] > max(least_docs, max_share * round(size, 6))}
    return {t: sum(n for x, n in held[t].items() if x in gone) for t in held}


def test_shares_against_brute_force(spark):
    import random

    rng = random.Random(5)
    common = [own(8000 + k, k=k + 3) for k in range(12)]  # of different lengths, so that none tie
    texts = [own(k, k=rng.randint(2, 30)) for k in range(60)]
    for k in range(120):
        some = rng.sample(common, rng.choice([1, 1, 2, 4]))
        texts.append("\n".join([*some, own(3000 + k, k=rng.choice([1, 2, 40]))]))
    for k in range(40):  # near copies
        texts.append("\n".join([*(own(8500 + j, k=20 + j) for j in range(5)), own(4000 + k, k=2)]))
    texts += texts[70:80]
    docs = cases.documents(spark, list(enumerate(texts))).drop("source").selectExpr("*", "'one' as source")
    wanted = brute_shares(set(texts))
    got = quality_rules(docs).collect()
    assert {r.doc_id: r.removed_words for r in got} == {k: wanted[t] for k, t in enumerate(texts)}
    depleted = {r.doc_id for r in got if not r.kept and not r.base_failed}
    assert depleted and any(r.removed_words and r.kept for r in got)
    assert {r.doc_id for r in got if 180 <= r.doc_id < 220 and r.kept} == set(range(180, 220))


def test_empty_table(spark):
    assert quality_rules(cases.empty(spark)).count() == 0

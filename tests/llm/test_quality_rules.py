"""Quality rules against a plain statement of the counts, and the shape of their plan."""

import collections
import re

from sparecast.llm.quality_rules import BASE_RULES, RULES, Rule, judged, quality_rules, select_by_rules, stop_forms

from .conftest import ODD_TEXTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    repeated = {k for v in windows.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
    blank = re.compile(r"^[\x20\x09-\x0D]*[-*•]"), re.compile(r"(\.\.\.|…)[\x20\x09-\x0D]*\Z")
    m = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_stop_words": sum(w in set(stop_forms()) for w in words), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
        "n_bullet_lines": sum(bool(blank[0].search(x)) for x in lines), "n_cut_lines": sum(bool(blank[1].search(x)) for x in lines),
        "n_capital_lines": sum(bool(re.search("[A-Z]", x)) and not re.search("[a-z]", x) for x in lines),
    }

    def broken(r):
        part, whole = 1000 * m[r.part], m[r.whole] if r.whole else 1
        return r.least is not None and part < r.least * whole or r.most is not None and part > r.most * whole

    m["base_failed"] = m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]
    m["failed"] = ",".join(r.name for r in (*BASE_RULES, *RULES) if broken(r))
    m["kept"] = not m["base_failed"] and not any(broken(r) for r in RULES)
    return m


def _same(rows, got):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed"]
    want = collections.Counter((i, *[plain(t)[k] for k in names]) for i, t in rows)
    assert collections.Counter(tuple(r) for r in got.select("doc_id", *names).collect()) == want


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    _same([(r.doc_id, r.text) for r in docs.collect()], quality_rules(docs))


def test_every_measure(spark):
    eight = "one two three four five six seven eight"
    rows = [
        (1, f"{eight} nine {eight} ten {eight}"), (2, f"{eight} {eight} {eight}"), (3, "a b " * 12), (4, eight),
        (5, f"{eight}\n{eight}\n\n \n{eight} "), (6, "- one\n * two\n• three\nfour..."), (7, "cut ...\nend… \nNOT"),
        (8, "ABC DEF\nÄÖ\nabc\n12 X"), (9, "# $ % & | < > * é€\U0001F600"), (10, " ".join(f"w{i}" for i in range(40))),
        (11, "The das und LE, le der Für für FÜR"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _same(rows, quality_rules(docs))
    names = ["n_stop_words", "n_lines", "n_bullet_lines", "n_cut_lines", "n_capital_lines"]
    for r in judged(docs).select("_row.*", *names).collect():
        assert [r[k] for k in names] == [plain(r.text)[k] for k in names], r


def test_odd_rows(spark, odd, empty):
    _same(ODD_TEXTS, quality_rules(odd))
    assert quality_rules(empty).count() == 0 and select_by_rules(empty).columns == empty.columns


def test_clashing_columns_stay(spark):
    text = "the fox and the dog went on to the end of that long road " * 2
    docs = spark.createDataFrame([(1, text, 5, "x", 2, True), (2, "", 6, "y", 3, False)],
                                 "doc_id long, text string, n_words long, _words string, _row int, kept boolean")
    got = select_by_rules(docs, rules=[Rule("stop words", "n_stop_words", "n_words", least=100)])
    assert got.columns == docs.columns and [tuple(r) for r in got.collect()] == []
    varied = " ".join(f"word{i} the" for i in range(15))
    docs = docs.union(spark.createDataFrame([(3, varied, 7, "z", 4, True)], docs.schema))
    assert [tuple(r) for r in select_by_rules(docs).collect()] == [(3, varied, 7, "z", 4, True)]


def test_plan_is_one_stage_of_built_in_functions(spark, sf):
    plan = quality_rules(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas|Generate", plan)

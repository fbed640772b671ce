import re

from shoplens.llm.line_quality import LineLimits, clean_documents, quality_rules

LIMITS = LineLimits(min_docs=3, max_share=0.05)
COLUMNS = "doc_id long, text string, source string, n_words int, kept string, _key int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x", 2) for i, t, s in rows], COLUMNS).repartition(4)


def _brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for k in range(len(words) - 4):
        at.setdefault(tuple(words[k:k + 5]), []).append(k)
    covered = {p + o for ps in at.values() if len(ps) > 1 for p in ps for o in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_base_measures_equal_brute_force(spark):
    texts = [None, "", " \n\t ", "one", "a b c d e a b c d e", "a a a a a a a a", "x\ny\nx\n\n  \nx ", "é ü # $ <b> | &",
             "tab\there\x0bvt\x0cff\rcr", " lead and trail ", "\U0001f600 " * 12, " ".join(f"w{i % 37}" for i in range(4000)),
             "w" * 20000, "a b c d e f g a b c d e h a b c d e", "*** ** *"]
    rows = [(i, t, "h") for i, t in enumerate(texts)] + [(3, "one", "h")]
    got = quality_rules(_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _brute(texts[r.doc_id]), r.doc_id
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)


def _unique(i, n=30):
    return " ".join(f"u{i}x{k}" for k in range(n))


def test_frequent_lines_go_and_depleted_documents_too(spark):
    line = "Share   this page with your many friends today and subscribe to our free news letter now\t!"
    same = "share this page WITH your many friends today and subscribe to our free news letter now !"
    rows = [(i, f"{_unique(i)}\n{line if i % 2 else same}", "a") for i in range(10)]
    rows += [(100 + i, f"w{i} z\n{line}", "a") for i in range(3)]  # little else: depleted
    rows += [(200, f"{_unique(200)}\n{line}", "b"), (201, f"{_unique(201)}\n{line}", None)]  # other hosts
    got = {r.doc_id: r for r in quality_rules(_frame(spark, rows), limits=LIMITS).collect()}
    assert all(got[i].kept and got[i].n_removed_lines == 1 for i in range(10))
    assert all(not got[100 + i].kept and not got[100 + i].base_failed for i in range(3))
    assert got[200].n_removed_lines == got[201].n_removed_lines == 0
    clean = {r.doc_id: r for r in clean_documents(_frame(spark, rows), limits=LIMITS).collect()}
    assert clean[4].text == _unique(4) and clean[200].text == rows[13][1] and 100 not in clean
    assert clean[4].asDict().keys() == {"doc_id", "text", "source", "n_words", "kept", "_key"}


def test_copies_do_not_make_boilerplate(spark):
    rows = [(i, _unique(7) + "\n" + _unique(8), "a") for i in range(50)]
    assert all(r.kept and r.n_removed_lines == 0 for r in quality_rules(_frame(spark, rows), limits=LIMITS).collect())


def test_a_shared_line_does_not_make_documents_one(spark):
    # 60 distinct documents a host, mostly one shared line of 80 words.
    hosts = {f"h{h}": " ".join(f"s{h}x{k}" for k in range(80)) for h in range(8)}
    rows = [(100 * n + i, f"{_unique(100 * n + i, 25)}\n{line}", h) for n, (h, line) in enumerate(hosts.items()) for i in range(60)]
    got = quality_rules(_frame(spark, rows)).collect()
    assert len(got) == 480 and all(r.n_removed_lines == 1 and not r.kept and not r.base_failed for r in got)


def test_empty_table_and_null_ids(spark):
    assert quality_rules(_frame(spark, []), limits=LIMITS).count() == 0
    rows = [(None, _unique(1), "a"), (None, _unique(1), "a"), (None, None, None)]
    assert clean_documents(_frame(spark, rows), limits=LIMITS).count() == 2


def test_no_python_in_the_plan(spark):
    plan = quality_rules(_frame(spark, [(1, "a", "b")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_sql_states_the_rule(spark):
    import duckdb
    import pyarrow as pa

    from shoplens.llm.oracle import OP9

    rows = []
    for h in range(3):
        line = " ".join(f"s{h}x{k}" for k in range(40))
        rows += [(1000 * h + i, f"{_unique(1000 * h + i, 12)}\n{line if i % 2 else line.upper() + '  '}", f"h{h}") for i in range(10 + 20 * h)]
        rows += [(1000 * h + 500 + i, _unique(7, 30) + "\n" + _unique(8, 30), f"h{h}") for i in range(40)]  # copies
    rows += [(9000, None, None), (9001, "", "h1"), (9002, " ".join(["a b c d e f"] * 9), "h1")]
    documents = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "source": [r[2] for r in rows]})
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.execute(OP9).to_arrow_table().to_pylist()
    got = [r.asDict() for r in quality_rules(_frame(spark, rows)).drop("removed", "_key").collect()]
    key = lambda r: sorted((k, repr(v)) for k, v in r.items())
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert sum(r["n_removed_lines"] > 0 for r in want) == 80 and any(not r["kept"] and not r["base_failed"] for r in want)

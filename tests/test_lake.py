"""Operators on small frames: the cases that bite."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions import columns as C
from tidemark.operators import changes, checks, dedup, hierarchy as H, history, margins, translator
from tidemark.plans import jobs
from tidemark.scratch import shared_path, stored
from tidemark.sources import commits, history_table, scans, sinks
from tidemark.streaming.append import append_new_files, closed_windows
from tidemark.streaming.changed import changed, observe


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_variants_take_what_exists(spark):
    df = spark.createDataFrame([(1, None, "b"), (2, "a", "x")], "k int, v string, v_pncp string")
    assert rows(C.harmonize_variants(df, ["v", "w"]), "k", "v", "w") == [(1, "b", None), (2, "a", None)]


def test_completeness_leaves_out_names_and_suffix(spark):
    df = spark.createDataFrame([(1, None, 3, "z")], "a int, b int, c_PNCP int, d string")
    assert df.select(C.completeness(df.columns, ["D"])).first()[0] == 1


def test_most_complete_row_wins_and_ties_are_settled(spark):
    df = spark.createDataFrame([(1, "d", None, "b"), (1, "d", "x", "b"), (1, "d", "x", "a")], "k int, t string, u string, v string")
    assert rows(dedup.keep_most_complete(df, ["k"], "t", ["k", "t"])) == [(1, "d", "x", "a")]


def test_history_with_a_null_date_has_two_current_rows(spark):
    d = dt.date
    df = spark.createDataFrame([(1, d(2024, 1, 1)), (1, d(2024, 2, 1)), (1, None), (2, d(2024, 1, 5))], "k int, t date")
    out = history.scd2(df, ["k"], "t")
    assert rows(out, "k", "t", "valido_ate", "is_current") == sorted([(1, d(2024, 1, 1), d(2024, 1, 31), False), (1, d(2024, 2, 1), None, True), (1, None, None, True), (2, d(2024, 1, 5), None, True)], key=repr)
    assert rows(checks.repeated_values(history.current(out), ["k"])) == [(1, 2)]
    assert rows(history.as_of(out, "2024-01-15"), "k", "t") == [(1, d(2024, 1, 1)), (2, d(2024, 1, 5))]


def test_load_history_may_end_before_it_starts(spark):
    t = dt.datetime
    df = spark.createDataFrame([("a", t(2024, 1, 1, 8)), ("a", t(2024, 1, 1, 20))], "k string, l timestamp_ntz")
    first = jobs.load_versions(df, ["k"], "l").orderBy("l").first()
    assert first["valido_ate"] < first["valido_de"]


def test_history_needs_one_exchange(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.current_date().alias("t"), F.col("id").alias("v"))
    plan = jobs.versioned(df, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2  # one, printed with its input


def test_snapshot_diff_sees_values_that_move_and_nulls(spark):
    s = "k int, a string, b string"
    old = spark.createDataFrame([(1, "a", None), (2, "x", "y"), (9, "g", "g")], s)
    new = spark.createDataFrame([(1, None, "a"), (2, "x", "y"), (3, None, None)], s)
    assert rows(changes.snapshot_diff(new, old, ["k"]), "k") == [(1,), (3,)]
    assert changes.snapshot_diff(old, old, ["k"], whole_first=True).count() == 0
    moved = spark.createDataFrame([(1, None, "a"), (2, "x", "y"), (9, "g", "g")], s)
    assert rows(changes.snapshot_diff(moved, old, ["k"], whole_first=True), "k") == [(1,)]
    nested = "k int, v struct<a:string,b:array<string>>"
    one, two = (spark.createDataFrame([(1, v)], nested) for v in ((None, ["x", None]), (None, [None, "x"])))
    assert rows(changes.snapshot_diff(one, two, ["k"], whole_first=True), "k") == [(1,)]
    assert changes.snapshot_diff(new, None, ["k"]).count() == 3


def test_manifest_diff_tells_all_states(spark):
    exp = spark.createDataFrame([(k,) for k in "abcde"], "k string")
    obs = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("e", "1")], "k string, hash_sha256 string")
    man = spark.createDataFrame([("a", "1", True), ("b", "2", True), ("d", "1", True), ("e", "1", False)], "k string, hash_sha256 string, there boolean")
    out = changes.manifest_diff(exp, obs, man, ["k"], present_col="there")
    assert rows(out, "k", "status") == [("a", "ignorado"), ("b", "atualizado"), ("c", "baixado"), ("d", "indisponivel"), ("e", "atualizado")]
    assert rows(changes.change_list(out, ["k"])) == [("b",), ("c",), ("e",)]


def test_calendar_with_and_without_the_open_month(spark):
    out = changes.period_calendar(spark, "2023-12-30", "2024-01-02")
    assert rows(out, "periodo") == sorted([(p,) for p in ("2023-12-30", "2023-12-31", "2024-01-01", "2024-01-02", "2023-12", "2024-01", "2023", "2024")], key=repr)
    assert rows(changes.period_calendar(spark, "2023-12-30", "2024-01-02", ("mensal",), last_open=True), "periodo") == [("2023-12",)]


def test_surrogate_ids_are_the_global_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    out = changes.surrogate_ids(df, [F.asc("v")])
    assert out.where("id <> v + 1").count() == 0 and out.count() == 1000


NODES = [("01", "A"), ("01.01", "B"), ("0101.2", "C"), ("0101.20", "D"), ("0101.20.1", "E"), ("0101.20.11", "F"), ("02", "G"), ("023", "odd"), ("0233", "under odd"), ("0399", "no chapter"), ("0201", "H")]


def test_tree_drops_branches_of_unknown_levels(spark):
    nodes = spark.createDataFrame(NODES, "codigo string, descricao string")
    out = H.enrich(nodes)
    assert {r[0] for r in rows(out, "codigo")} == {"01", "01.01", "0101.2", "0101.20", "0101.20.1", "0101.20.11", "02", "0201"}
    leaf = out.where("codigo = '0101.20.11'").first()
    assert leaf["caminho"].endswith("A > B > C > D > E > F") and leaf["posicao_codigo"] == "01.01" and leaf["subitem_codigo"] == "0101.20.11"
    assert dict(rows(H.parents(nodes)))["0233"] == "023"
    assert dict(rows(H.descendant_count(nodes)))["01"] == 5
    look = rows(H.prefix_lookup(out), "prefixo", "codigo", "capitulo_codigo")
    assert ("01", "01012011", "01") in look and len(look) == 6


def test_nested_json_becomes_rows_and_the_last_wins(spark):
    doc = '[{"Codigo":"01","Descricao":"a","NomenclaturaFilha":[{"Codigo":"0101","Descricao":"b"},{"Codigo":"01","Descricao":"again"}]},{"Codigo":"02","Descricao":"c"}]'
    assert rows(scans.flatten_tree(spark.createDataFrame([(doc,)], "doc string"), "doc")) == [("01", "again"), ("0101", "b"), ("02", "c")]


def test_margin_events_of_successive_regulations(spark):
    s = "resolucao string, ncm string, regra_de_origem string, margem_normal string, regra_de_qualificacao string, margem_adicional string, grupo_de_produtos string, comentario string"
    sheet = spark.createDataFrame([("r1", " 01 ", "o", "20", "a b", "10", None, None), ("r1", "", "o", "20", None, None, None, None), ("r2", "02", "o", "12,5", None, " ", None, None)], s)
    out = margins.succession_events(sheet, ["r1", "r2"])
    got = rows(out, "resolucao", "tipo_evento_margem", "tipo_margem", "prefixo_ncm", "margem_normal_pct", "margem_adicional_comprovante")
    assert got == sorted([("r1", "habilita", "conteudo_nacional", "01", 0.2, None), ("r1", "habilita", "tecnologia_nacional", "01", 0.2, "a_b"), ("r2", "habilita", "conteudo_nacional", "02", None, None), ("r2", "desabilita", "conteudo_nacional", "01", 0.2, None), ("r2", "desabilita", "tecnologia_nacional", "01", 0.2, "a_b")], key=repr)
    assert margins.sheet_events(sheet, True).count() == 3


def test_translator_never_mixes_human_and_model(spark):
    s = "catmat int, ncm string, ncm_capitulo_sugerido_cod string, ncm_posicao_sugerida_cod string, ncm_subitem_sugerido_top_5_cod array<string>"
    df = spark.createDataFrame([(1, "01", "99", "9999", ["99999999"]), (2, None, "99", "9999", ["99999999"]), (3, None, None, None, []), (4, "01020304", "9", "9", ["9"])], s)
    assert rows(translator.resolve_codes(df)) == [(1, "01", None, None, "humano"), (2, "99", "9999", "99999999", "ia"), (3, None, None, None, None), (4, "01", "0102", "01020304", "humano")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        translator.stage_suggestions(spark.createDataFrame([("x1",)], "catmat string")).collect()


def test_checks_and_contract(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "k int, v string")
    assert rows(checks.null_violations(df, ["k", "v"])) == [("k", 1), ("v", 1)]
    assert rows(checks.values_outside(df, "v", ["a"])) == [("b", 1)]
    assert checks.contract_breaks(df, T.StructType([T.StructField("k", T.LongType()), T.StructField("z", T.StringType())])) == ["missing z", "unexpected v", "k is int, not bigint"]


def test_append_repeats_nothing(spark):
    target = shared_path(spark, "t")
    df = spark.createDataFrame([("2024", 1), ("2023", 2)], "p string, v int")
    assert sinks.incremental_append(df, df.limit(0), ["p"], target).count() == 2
    assert sinks.incremental_append(df, df.limit(0), ["p"], target).count() == 2
    assert sinks.incremental_append(df, df.where("p = '2024'"), ["p"], target).count() == 3


def test_drifting_files_and_keys_in_paths(spark):
    base = shared_path(spark, "d")
    spark.createDataFrame([(1, 5)], "k int, v int").write.parquet(f"{base}/drop-mensal-compras/compras-2024-01.parquet")
    spark.createDataFrame([("2", "x")], "k string, n string").write.parquet(f"{base}/drop-diario-compras/compras-2024-02-03.parquet")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])
    parts = [scans.with_file_keys(spark.read.parquet(f"{base}/{p}"), "compras") for p in ("drop-mensal-compras/compras-2024-01.parquet", "drop-diario-compras/compras-2024-02-03.parquet")]
    assert rows(scans.union_by_name(parts, schema), "k", "v", "granularidade", "periodo", "n") == [(1, 5.0, "mensal", "2024-01", None), (2, None, "diario", "2024-02-03", "x")]


def test_stream_appends_each_file_once(spark):
    src, target, marks = (shared_path(spark, n) for n in ("in", "out", "marks"))
    df = spark.range(10)
    df.write.parquet(src)
    assert append_new_files(spark, src, df.schema, target, marks) == 1
    assert append_new_files(spark, src, df.schema, target, marks) == 0
    assert spark.read.parquet(target).count() == 10


def test_csv_with_line_feeds_needs_multi_line(spark):
    src = shared_path(spark, "csv")
    os.makedirs(src)
    with open(f"{src}/drop.csv", "w") as f:
        f.write('k,v\n1,"a\nb"\n2,"say ""x"""\n')
    assert rows(scans.read_csv(spark, src, "k int, v string", multi_line=True)) == [(1, "a\nb"), (2, 'say "x"')]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        scans.read_csv(spark, src, "k int, v string").collect()


def test_deeper_trees_than_allowed_fail(spark):
    doc = '[{"Codigo":"1","NomenclaturaFilha":[{"Codigo":"2","NomenclaturaFilha":[{"Codigo":"3","NomenclaturaFilha":[]}]}]}]'
    df = spark.createDataFrame([(doc,)], "doc string")
    assert scans.flatten_tree(df, "doc", depth=3).count() == 3
    with pytest.raises(Exception, match="more than 2 levels"):
        scans.flatten_tree(df, "doc", depth=2).collect()


def test_manifest_of_a_manifest_and_crashes(spark):
    base = shared_path(spark, "m")
    sinks.save_manifest(spark.createDataFrame([(2, "b"), (1, "a")], "k int, h string"), ["k"], base, "1")
    spark.createDataFrame([(9, "half")], "k int, h string").write.parquet(f"{base}/version=2")  # a run that died before its pointer
    assert rows(sinks.current_snapshot(spark, base), "k", "h") == [(1, "a"), (2, "b")]
    sinks.save_manifest(sinks.current_snapshot(spark, base).where("k = 1"), ["k"], base, "3")
    assert rows(sinks.current_snapshot(spark, base), "k", "h") == [(1, "a")]


def test_names_are_looked_for_in_whole_texts(spark):
    src = spark.createDataFrame([(1, "s3/x/run-01.csv"), (2, "run-0"), (3, None), (4, "yrun-01.csvz"), (4, "yrun-01.csvz"), (5, "ab")], "k int, p string")
    names = spark.createDataFrame([("run-01.csv",), ("run-01.csv",), ("b",), ("",), (None,)], "n string")
    assert rows(sinks.containing_rows(src, "p", names, "n"), "k") == [(1,), (4,), (4,), (5,)]
    assert sinks.containing_rows(src, "p", names.limit(0), "n").count() == 0


def test_expired_loads_are_listed_then_dropped(spark):
    base = shared_path(spark, "l")
    for day in ("2024-01-01", "2024-01-20"):
        sinks.write_delta(spark.range(3), base, day)
    assert sinks.drop_expired_loads(spark, base, "2024-01-25", 7) == ["2024-01-01"]
    assert spark.read.parquet(base).count() == 6
    assert sinks.drop_expired_loads(spark, base, "2024-01-25", 7, dry_run=False) == ["2024-01-01"]
    assert spark.read.parquet(base).count() == 3


def test_strict_cast_fails_whatever_the_setting(spark):
    bad = spark.createDataFrame([("1",), (None,), (" 2 ",)], "c string")
    assert rows(bad.select(C.strict_cast("c", "int"))) == [(1,), (2,), (None,)]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            spark.createDataFrame([("x",)], "c string").select(C.strict_cast("c", "int")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_tree_plans_read_their_nodes_few_times(spark, data):
    from tidemark.plans import queries as Q

    for name in ("tree_enrich", "prefix_lookup", "active_margins"):
        plan = Q.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") < 10, name


def test_scratch_is_cleared_and_needs_a_shared_folder(spark):
    from types import SimpleNamespace

    from tidemark import scratch

    made = dict(scratch._made)
    try:
        scratch._made.clear()
        path, name = shared_path(spark, "gone"), scratch.shared_table(spark, "gone")
        spark.range(3).write.parquet(path)
        spark.range(3).write.saveAsTable(name)
        assert scratch.clear_scratch(spark) == 2 and not sinks.path_exists(spark, path) and not spark.catalog.tableExists(name)
    finally:
        scratch._made.update(made)
    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="a", getConf=lambda: SimpleNamespace(get=lambda k: None)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_path(far, "x")


def written(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_csv_columns_go_by_name(spark):
    base = shared_path(spark, "named")
    written(f"{base}/1.csv", "a,b\n01,2\n")
    written(f"{base}/2.csv", "b,A\n3,04\n")
    written(f"{base}/3 [x].csv", "﻿b\n5\n")
    written(f"{base}/4.csv", "b,a\n6,07\n")
    written(f"{base}/5.csv", "")
    written(f"{base}/6.csv", "a,b\n")
    out = scans.read_csv(spark, f"{base}/*.csv", "a string, b int", path_col="p")
    assert rows(out, "a", "b") == sorted([("01", 2), ("04", 3), (None, 5), ("07", 6)], key=repr)
    assert {os.path.basename(r[0]) for r in rows(out, "p")} >= {"1.csv", "4.csv"}
    assert len(scans.header_signatures(spark, f"{base}/*.csv")) == 4  # (a, b), (b, A), (b), (b, a)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 4
    written(f"{base}/7.csv", "b,extra,a\n8,x,09\n")
    with pytest.raises(ValueError, match="extra"):
        scans.read_csv(spark, f"{base}/*.csv", "a string, b int")
    kept = scans.read_csv(spark, f"{base}/*.csv", "a string, b int", unknown="keep")
    assert kept.columns == ["a", "b", "extra"] and ("09", 8, "x") in rows(kept)
    assert scans.read_csv(spark, f"{base}/7.csv", "a string, b int", unknown="drop").collect() == [("09", 8)]
    written(f"{base}/8.csv", "a,b,A\n1,2,3\n")
    with pytest.raises(ValueError, match="twice"):
        scans.read_csv(spark, f"{base}/8.csv", "a string, b int")
    written(f"{base}/9.csv", 'b;"a"\n1;"x;""y"""\n'.replace("x", "ç"), "latin-1")
    assert rows(scans.read_csv(spark, f"{base}/9.csv", "a string, b int", sep=";", encoding="ISO-8859-1")) == [('ç;"y"', 1)]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        written(f"{base}/10.csv", "b,a\nx,1\n")
        scans.read_csv(spark, f"{base}/10.csv", "a string, b int").collect()


def test_commits_are_numbered_and_made_once(spark):
    base = shared_path(spark, "log")
    first = commits.state(spark, base)
    one = commits.commit(spark, base, first, "r1", ["a"])
    with pytest.raises(commits.CommitConflict):
        commits.commit(spark, base, first, "r2", ["b"])
    for k in range(2, 12):
        one = commits.commit(spark, base, one, f"r{k}", [str(k)])
    assert commits.state(spark, base) == one and one.number == 11 and one.runs["r1"] == 1
    assert not [f for f in os.listdir(f"{base}/_commits") if not f.strip(".").split(".")[0].isdigit() and f.endswith(".json")]


def test_append_of_a_run_counts_once(spark):
    target = shared_path(spark, "once")
    df = spark.createDataFrame([("2024", 1), ("2023", 2)], "p string, v int")
    for run in ("1", "1", "2", "2"):
        sinks.incremental_append(df, df.where("p = '2024'"), ["p"], target, run=run)
    assert rows(commits.committed(spark, target, df.schema)) == [("2023", 2), ("2024", 1), ("2024", 1)]
    df.write.parquet(f"{target}/data/append-of-a-run-that-died")
    assert commits.committed(spark, target, df.schema).count() == 3


def test_the_last_commit_is_the_newest_version(spark):
    base = shared_path(spark, "versions")
    for v in ("9", "10"):
        sinks.replace_snapshot(spark.createDataFrame([(v,)], "v string"), base, v)
    assert rows(sinks.current_snapshot(spark, base)) == [("10",)]
    sinks.replace_snapshot(spark.createDataFrame([("again",)], "v string"), base, "10")
    assert rows(sinks.current_snapshot(spark, base)) == [("10",)]


TIME = dt.datetime(2024, 1, 1, 0, 0, 0, 1)


def test_prints_tell_what_fields_tell(spark):
    kinds = "k int, d double, a array<timestamp_ntz>, m map<string,array<double>>, s struct<x:string,y:map<int,string>>, t timestamp_ntz, b binary"
    base = (1, float("nan"), [TIME, None], {"p": [1.0, None], "q": None}, ("v", {1: "a", 2: None}), TIME, b"\x00")
    other = [(1, None), (2, [TIME + dt.timedelta(microseconds=1), None]), (2, [None, TIME]), (2, [TIME]), (2, None), (2, []), (3, {"p": [1.0, None]}), (3, {"p": [None, 1.0], "q": None}), (3, None), (3, {}), (4, ("v", {1: "a", 2: ""})), (4, (None, {1: "a", 2: None})), (4, None), (5, TIME + dt.timedelta(microseconds=1)), (6, b""), (6, None)]
    told = [base] + [(*base[:i], v, *base[i + 1 :]) for i, v in other]
    same = (*base[:3], {"q": None, "p": [1.0, None]}, ("v", {2: None, 1: "a"}), *base[5:])
    frames = [spark.createDataFrame([r], kinds) for r in [*told, same]]
    every = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate([*told, same])], kinds)
    marks = [r[0] for r in every.orderBy("k").select(changes.row_print(every.drop("k").schema)).collect()]
    assert len(set(marks[:-1])) == len(told) and marks[-1] == marks[0]
    for k in (1, 5, 7, 11, 12):
        for fast in (True, False):
            assert changes.snapshot_diff(frames[k], frames[0], ["k"], whole_first=fast).count() == 1, k
    assert changes.snapshot_diff(frames[-1], frames[0], ["k"]).count() == 0
    assert changes.snapshot_diff(frames[0], frames[0], ["k"]).count() == 0


def test_differences_read_only_buckets_that_differ(spark):
    base = shared_path(spark, "digest")
    old = spark.range(2000).select("id", (F.col("id") * 3).alias("v"), F.array(F.lit(None).cast("int")).alias("a"))
    sinks.replace_snapshot(old, base, "1", keys=["id"], buckets=100)
    new = old.withColumn("v", F.when(F.col("id") == 77, 0).otherwise(F.col("v")))
    out = sinks.changes_since(new, base, ["id"])
    assert rows(out, "id", "v") == [(77, 0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    (bucket,) = {r[0] for r in rows(new.where("id = 77").select(sinks.key_bucket(new, ["id"], 100)))}
    assert f"PartitionFilters: [isnotnull(_bucket" in plan and f"= {bucket})" in plan
    assert sinks.changes_since(old, base, ["id"]).count() == 0
    with pytest.raises(ValueError, match="digests"):
        sinks.changes_since(new, base, ["v"])
    assert sinks.current_snapshot(spark, base).columns == ["id", "v", "a"]


def test_history_merges_touch_their_buckets_only(spark):
    d = dt.date
    s = "k string, t date, v string"
    loads = [
        [("a", d(2024, 1, 1), "1"), ("b", d(2024, 1, 1), None), ("c", d(2024, 1, 5), "x")],
        [("a", d(2024, 3, 1), "3"), ("b", d(2024, 1, 1), "filled"), ("d", None, "n")],
        [("a", d(2024, 2, 1), "late"), ("a", d(2024, 3, 1), "3"), (None, d(2024, 1, 1), "null key")],
    ]
    base, every = shared_path(spark, "hist"), []
    for k, load in enumerate(loads):
        before = commits.state(spark, base).info.get("held", {})
        touched = history_table.merge_history(spark.createDataFrame(load, s), base, ["k"], "t", run=str(k), buckets=32)
        every += load
        held = commits.state(spark, base).info["held"]
        assert {b for b in held if held[b] != before.get(b)} == set(map(str, touched)) and len(touched) <= 3
        want = jobs.versioned(spark.createDataFrame(every, s), ["k"], "t")
        assert rows(history_table.history(spark, base), *want.columns) == rows(want)
    assert history_table.merge_history(spark.createDataFrame(loads[0], s), base, ["k"], "t", run="1") == []
    one = history_table.history_rows(spark, base, touched[:1])
    assert one.inputFiles() and all(f"/_bucket={touched[0]}/" in f for f in one.inputFiles())
    assert history_table.merge_history(spark.createDataFrame([], s), base, ["k"], "t", run="9") == []


def test_history_by_load_time_keeps_every_load(spark):
    t = dt.datetime
    base = shared_path(spark, "loads")
    loads = [("a", t(2024, 1, 1, 8), 1), ("a", t(2024, 1, 1, 20), 2), ("a", t(2024, 1, 1, 20), 2)]
    for k, load in enumerate(loads):
        history_table.merge_history(spark.createDataFrame([load], "k string, l timestamp_ntz, v int"), base, ["k"], "l", run=str(k), by_time=True)
    want = jobs.load_versions(spark.createDataFrame(loads, "k string, l timestamp_ntz, v int"), ["k"], "l")
    assert rows(history_table.history(spark, base), *want.columns) == rows(want)


def test_a_file_changed_under_its_name_is_seen_in_a_stream(spark):
    files, looks, target, marks = (shared_path(spark, n) for n in ("files", "looks", "told", "marks"))
    schema = T.StructType.fromDDL("path string, hash_sha256 string, visto_em string")
    out = T.StructType([*schema, T.StructField("status", T.StringType())])
    contents = [{"a": "1", "b": "1"}, {"a": "1", "b": "2", "c": "1"}, {"a": "3", "b": "2", "c": "1"}]
    manifest = spark.createDataFrame([], "path string, hash_sha256 string")
    for k, content in enumerate(contents):
        for name, text in content.items():
            written(f"{files}/{name}.txt", text)
        observe(spark, f"{files}/*.txt", looks, str(k))
        assert changed(spark, looks, schema, target, marks, ["path"]) >= 1  # each run starts anew from the checkpoint
        now = commits.committed(spark, target, out).where(F.col("visto_em") == str(k)).select("path", "hash_sha256", "status")
        observed = scans.file_metrics(spark, f"{files}/*.txt").select("path", "hash_sha256")
        want = changes.manifest_diff(observed, observed, manifest, ["path"])
        assert rows(now) == rows(want, "path", "hash_sha256", "status")
        manifest = spark.createDataFrame(observed.collect(), "path string, hash_sha256 string")
    assert changed(spark, looks, schema, target, marks, ["path"]) == 0
    told = {(os.path.basename(r.path), r.visto_em): r.status for r in commits.committed(spark, target, out).collect()}
    assert told["b.txt", "1"] == "atualizado" and told["a.txt", "2"] == "atualizado" and told["c.txt", "1"] == "baixado" and told["b.txt", "2"] == "ignorado"


def test_late_rows_are_dropped_and_counted(spark):
    src, target, marks = (shared_path(spark, n) for n in ("in", "windows", "marks"))
    schema = T.StructType.fromDDL("t timestamp, k string")
    day = lambda h: dt.datetime(2024, 1, 1, h)
    lost = []
    for batch in ([(day(8), "a"), (day(9), "a")], [(day(8), "a"), (day(15), "a")], [(day(8), "a"), (day(9), "b"), (day(16), "b")], [(day(20), "a")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        lost.append(closed_windows(spark, src, schema, target, marks, "t", "1 hour", "2 hours", "k"))
    out = commits.committed(spark, target, T.StructType.fromDDL("window_start timestamp, k string, n long"))
    assert lost == [0, 0, 2, 0]  # the third batch's first two came when their windows had closed
    assert rows(out) == sorted([(day(8), "a", 2), (day(9), "a", 1), (day(15), "a", 1), (day(16), "b", 1)], key=repr)


def test_names_that_begin_alike_meet_few_texts(spark):
    stamp = F.concat(F.lit("ncm_2024-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((F.col("id") * 7919 % 1000003).cast("string"), 7, "0"), F.lit(".csv"))
    src = spark.range(100_000).select("id", F.concat(F.lit("s3/lake/"), stamp).alias("p"))
    names = spark.range(0, 100_000, 100).select(stamp.alias("n"))
    assert sinks.containing_rows(src, "p", names, "n").count() == 1000
    assert sinks.contained_names(src, "id", "p", names, "n").count() <= 2000


def test_only_grams_that_tell_names_apart_are_kept_of_texts(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(sinks, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    stamp = F.concat(F.lit("ncm_2024-"), F.lpad((F.col("id") * 7919 % 1000003).cast("string"), 7, "0"), F.lit(".csv"))
    src, names = spark.range(20_000).select("id", F.concat(F.lit("s3/lake/"), stamp).alias("p")), spark.range(0, 20_000, 100).select(stamp.alias("n"))
    assert sinks.containing_rows(src, "p", names, "n").count() == 200
    assert kept["grams"].count() < 2 * 20_000  # those of the common beginning alone are more


def test_grams_of_names_are_never_broadcast(spark):
    names = spark.range(200).select(F.format_string("ncm_2024-%07d.csv", "id").alias("n"))
    out = sinks.offered_grams(names, "n")
    assert out.count() == 200 * sinks.OFFERED and out.where("_k = 8").select("_name").distinct().count() == 200
    out.collect()
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()  # as it ran, sizes being known


def test_histories_and_trees_are_dealt_by_rows(spark, monkeypatch):
    monkeypatch.setattr(jobs.by_keys, "__defaults__", (10,))
    df = spark.range(100).select((F.col("id") % 40).alias("k"), F.current_date().alias("t"), F.col("id").alias("v"))
    assert "hashpartitioning(k#" in (plan := jobs.versioned(df, ["k"], "t")._jdf.queryExecution().executedPlan().toString()) and ", 10)" in plan
    assert jobs.versioned(df, ["k"], "t").where("is_current").count() == 40
    docs = spark.range(0, 50, 1, 1).select(F.format_string('[{"Codigo":"%d","Descricao":"d"}]', "id").alias("doc"))
    assert scans.dealt(docs, 5).rdd.getNumPartitions() == 10


def test_trees_of_nine_levels_and_bad_ones(spark):
    doc = ""
    for k in range(9, 0, -1):
        doc = '[{"Codigo":"%d","Descricao":"d%d"%s}]' % (k, k, f',"NomenclaturaFilha":{doc}' if doc else ',"NomenclaturaFilha":null')
    df = spark.createDataFrame([(doc,), ("[]",), (None,), ('[{"Descricao":"no code","NomenclaturaFilha":[]}]',)], "doc string")
    assert rows(scans.flatten_tree(df, "doc")) == [(str(k), f"d{k}") for k in range(1, 10)]
    assert scans.flatten_tree(df.limit(0), "doc").collect() == []
    with pytest.raises(Exception, match="MALFORMED"):
        scans.flatten_tree(spark.createDataFrame([("[{",)], "doc string"), "doc").collect()


def test_a_database_table_is_dealt_by_its_keys_quantiles(spark):
    url, options = "jdbc:derby:memory:skewed;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    key = F.when(F.col("id") % 11 != 0, F.col("id") * F.col("id") * F.col("id"))
    spark.range(22_000).select(key.alias("k"), F.col("id").alias("v")).coalesce(1).write.jdbc(url, "t", properties=options)
    out = scans.jdbc_table(spark, url, "t", "k", 8, **options)
    sizes = sorted(r[0] for r in out.where("k is not null").groupBy(F.spark_partition_id()).count().select("count").collect())
    assert out.count() == 22_000 and out.select("v").distinct().count() == 22_000 and out.where("k is null").count() == 2000
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    spark.createDataFrame([(None, 1)], "k long, v long").write.jdbc(url, "empty_keys", properties=options)
    assert rows(scans.jdbc_table(spark, url, "empty_keys", "k", 4, **options)) == [(None, 1)]
    spark.createDataFrame([(5, 1), (5, 2)], "k long, v long").write.jdbc(url, "one_key", properties=options)
    assert rows(scans.jdbc_table(spark, url, "one_key", "k", 4, **options)) == [(5, 1), (5, 2)]


def test_checks_ride_on_the_write(spark):
    base = shared_path(spark, "checked")
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, 2.0), (None, "z", 3.0)], "k int, v string, x double")
    rules = {"k": F.col("k").isNotNull(), "v": F.col("v").isin("a", "b")}
    told = sinks.checked_snapshot(df, base, "1", rules, {"k": 1, "v": 2}, {"x": ("x", "6.5")})
    assert told == {"rows": 3, "broken_k": 1, "broken_v": 2, "sum_x": "6.5"}
    assert rows(sinks.checked(spark, base)) == [(1, "a", 1.5)]
    assert rows(sinks.quarantined(spark, base), "x", "_broken") == [(2.0, ["v"]), (3.0, ["k", "v"])]
    for limits, totals in (({"k": 0}, {}), ({}, {"x": ("x", "7.0")})):
        with pytest.raises(sinks.QualityFailed):
            sinks.checked_snapshot(df.limit(3), base, "2", rules, limits, totals)
        assert rows(sinks.checked(spark, base)) == [(1, "a", 1.5)]
    assert sinks.checked_snapshot(df.where("k = 1"), base, "3", rules)["rows"] == 1
    assert sinks.quarantined(spark, base).count() == 0


def test_reading_a_day_leaves_older_months_unread(spark):
    d, base = dt.date, shared_path(spark, "ends")
    df = spark.createDataFrame([(k, d(2024, m, 3)) for k in range(3) for m in range(1, 13)] + [(9, None)], "k int, t date")
    told = history.scd2(df, ["k"], "t")
    sinks.history_by_end(told, base, "1")
    for day in ("2023-01-01", "2024-02-02", "2024-06-15", "2025-01-01"):
        assert rows(sinks.history_on(spark, base, day)) == rows(history.as_of(told, day))
    plan = sinks.history_on(spark, base, "2024-06-15")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_end" in plan and ">= 2024-06" in plan


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_intervals_of_trees_in_any_ranges(spark, parts):
    import random

    rng = random.Random(parts)
    codes = {"".join(rng.choice("012") for _ in range(rng.randrange(1, 7))) for _ in range(150)} | {"2"}
    codes |= {"01.2", "012", "0.12", "x", "", "2.1"} | {f"2.{c}" for c in sorted(codes)[:40]}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(c,) for c in [*codes, *sorted(codes)[:30]]] + [(None,)], "codigo string")
        told = {r.codigo: r for r in H.intervals(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    plain = {c: "".join(x for x in c if x.isdigit()) for c in codes}
    order = sorted(codes, key=lambda c: (plain[c], c))
    assert set(told) == codes and all(told[c].ordem == k for k, c in enumerate(order, 1))
    for c in codes:
        over = [x for x in codes if plain[x] and plain[c].startswith(plain[x]) and plain[x] != plain[c]]
        under = [x for x in codes if plain[c] and plain[x].startswith(plain[c]) and plain[x] != plain[c]]
        nearest = min((x for x in over if plain[x] == max((plain[o] for o in over), key=len)), default=None)
        twins = [x for x in codes if plain[x] == plain[c]]
        assert (told[c].profundidade, told[c].pai, told[c].n_descendentes) == (len({plain[x] for x in over}), nearest, len(under)), c
        assert told[c].fim == max(told[x].ordem for x in [*twins, *under])
        assert told[c].n_filhos == sum(told[x].pai == c for x in codes)


def test_files_too_large_to_hold_are_hashed_as_streams(spark):
    import hashlib

    base = shared_path(spark, "big")
    written(f"{base}/small.txt", "a,b\n")
    written(f"{base}/large.txt", "xyz\n" * 500_000)
    told = {os.path.basename(r.path): (r.tamanho_bytes, r.hash_sha256) for r in scans.file_metrics(spark, f"{base}/*.txt", whole=1000).collect()}
    want = {n: open(f"{base}/{n}", "rb").read() for n in ("small.txt", "large.txt")}
    assert told == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in want.items()}


def test_rows_know_their_files_name(spark):
    base = shared_path(spark, "named")
    spark.range(3).coalesce(1).write.parquet(base)
    (name,) = [f for f in os.listdir(base) if f.endswith(".parquet")]
    assert rows(scans.with_file_name(spark.read.parquet(base))) == [(k, name) for k in range(3)]


def test_commits_are_compacted_and_what_none_counts_goes(spark):
    base = shared_path(spark, "vacuum")
    df = spark.range(10).select("id", (F.col("id") % 3).alias("v"))
    for k in range(4):
        sinks.append_once(df.where(F.col("v") == k % 3), base, str(k))
    want = rows(commits.committed(spark, base, df.schema))
    df.write.parquet(f"{base}/data/append-of-a-run-that-died")
    now = commits.compact(spark, base, df.schema)
    assert len(now.folders) == 1 and now.number == 5 and rows(commits.committed(spark, base, df.schema)) == want
    assert sinks.append_once(df, base, "2") == now  # runs from before are still known
    assert commits.vacuum(spark, base, dry_run=False) == []  # written a moment ago
    assert commits.unused(spark, base, keep=2, idle_hours=0) == ["data/append-of-a-run-that-died"]  # the commit before counts the others
    assert len(commits.vacuum(spark, base, keep=1, idle_hours=0, dry_run=False)) == 5
    assert rows(commits.committed(spark, base, df.schema)) == want and commits.unused(spark, base, keep=1, idle_hours=0) == []
    assert commits.unused(spark, shared_path(spark, "nothing")) == []

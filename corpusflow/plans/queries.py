"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (or data Spark derives from them) in
full; column names match :mod:`corpusflow.plans.oracle`.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.operators import filters, pairs, stats
from corpusflow.plans import fixtures as FX

PAIRS = FX.UNIT_PAIRS


def _docs(spark, sf_dir):
    return FX.table(spark, sf_dir, "documents")


def q_normalize_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    f1 = FX.line_pairs(_docs(spark, sf_dir)).select("doc_id", "line_no", "source_lang", "target_lang",
                                                    "source", "target")
    out = T.normalize_columns(f1, [("source", F.col("source_lang")), ("target", F.col("target_lang"))])
    return out.select("doc_id", "line_no", "source_lang", "source", "target")


def q_translation_ids(spark, sf_dir):
    return FX.corpus(_docs(spark, sf_dir)).select("id", "classifier", "source", "target", "langs")


def _cleaned(spark, sf_dir, lexicon=None, profile=None):
    return filters.clean(FX.units(_docs(spark, sf_dir)), PAIRS, lexicon=lexicon, profile=profile)


def q_clean_pairs(spark, sf_dir):
    return filters.clean_pairs(FX.units(_docs(spark, sf_dir)), PAIRS).select(
        "doc_id", "line_no", "id", "classifier", "source", "target", "langs")


def q_reject_counts(spark, sf_dir):
    return filters.reject_counts(_cleaned(spark, sf_dir))


def q_dedup_rows(spark, sf_dir):
    return pairs.dedup_rows(FX.corpus(_docs(spark, sf_dir)))


def q_dedup_pairs(spark, sf_dir):
    return pairs.dedup_pairs(FX.corpus(_docs(spark, sf_dir)))


def q_segment_stats(spark, sf_dir):
    """Flagship: documents -> two-language units -> clean -> de-duplicate -> stats."""
    kept = filters.clean_pairs(FX.units(_docs(spark, sf_dir)), PAIRS).select("id", "classifier", "source", "target", "langs")
    return stats.segment_stats(pairs.dedup_pairs(kept), keys=("classifier",))


def q_alpha_tokens(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return docs.select("doc_id", F.posexplode(T.alpha_tokens("text", F.col("lang"))).alias("pos", "word")) \
               .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "word")


QUERIES = {
    "normalize_lines": q_normalize_lines,
    "translation_ids": q_translation_ids,
    "clean_pairs": q_clean_pairs,
    "reject_counts": q_reject_counts,
    "dedup_rows": q_dedup_rows,
    "dedup_pairs": q_dedup_pairs,
    "segment_stats": q_segment_stats,
    "alpha_tokens": q_alpha_tokens,
}


# --- language identification and spelling ------------------------------------
from corpusflow.operators import affixes, langid, spelling  # noqa: E402


def _profile(spark, sf_dir):
    return langid.train_lang_profile(_docs(spark, sf_dir).select("lang", "text"))


def q_lang_profile(spark, sf_dir):
    p = _profile(spark, sf_dir)
    return p.select("lang", "gram", "cnt", F.round("logp", 6).alias("logp"),
                    F.round("unseen_logp", 6).alias("unseen_logp"))


def q_lang_detect(spark, sf_dir):
    f1 = FX.line_pairs(_docs(spark, sf_dir)).select("doc_id", "line_no", F.col("source_lang").alias("lang"), "source")
    return langid.detect_lang(f1, _profile(spark, sf_dir), "source").drop("source")


def _lexicon(spark, sf_dir):
    return spelling.build_lexicon(_docs(spark, sf_dir))


def _clean_kept(spark, sf_dir):
    return filters.clean_pairs(FX.units(_docs(spark, sf_dir)), PAIRS)


def q_lexicon(spark, sf_dir):
    return _lexicon(spark, sf_dir)


def q_misspelt_words(spark, sf_dir):
    bad = spelling.misspelt_words(_clean_kept(spark, sf_dir), _lexicon(spark, sf_dir))
    return spelling.misspelt_counts(bad)


def q_misspelt_sentences(spark, sf_dir):
    bad = spelling.misspelt_words(_clean_kept(spark, sf_dir), _lexicon(spark, sf_dir))
    return spelling.misspelt_sentences(bad)


def q_spelling_gate(spark, sf_dir):
    return filters.clean_pairs(FX.units(_docs(spark, sf_dir)), PAIRS, lexicon=_lexicon(spark, sf_dir)).select("doc_id", "line_no", "id", "classifier", "source", "target", "langs")


def q_affix_words(spark, sf_dir):
    """SPL2 with an affix dictionary: the forms that no stem, rule or compound accounts for."""
    # plain letters, so that both engines take the same characters
    lexicon = vocab._written(_lexicon(spark, sf_dir).where(F.col("word").rlike("^[a-z]{3,}$")))
    rules = affixes.parse_rules(FX.AFFIX_RULES.splitlines())
    langs = [r.lang for r in lexicon.select("lang").distinct().collect()]
    lines = FX.dictionary_lines(lexicon)
    stems = reduce(DataFrame.unionByName, [affixes.parse_stems(lines.where(F.col("lang") == x), x, rules) for x in langs])
    return affixes.AffixDictionary(stems, {x: rules for x in langs}).unknown(FX.word_forms(lexicon)).select("lang", "word")


def q_lang_gate(spark, sf_dir):
    kept = filters.clean_pairs(FX.units(_docs(spark, sf_dir)), PAIRS, profile=_profile(spark, sf_dir))
    return kept.select("doc_id", "line_no", "id", "classifier", "source", "target", "langs")


QUERIES.update({
    "affix_words": q_affix_words,
    "lang_gate": q_lang_gate,
    "lang_profile": q_lang_profile,
    "lang_detect": q_lang_detect,
    "lexicon": q_lexicon,
    "misspelt_words": q_misspelt_words,
    "misspelt_sentences": q_misspelt_sentences,
    "spelling_gate": q_spelling_gate,
})


# --- splitting ------------------------------------------------------------------
from corpusflow.operators import splits  # noqa: E402


def _split_input(spark, sf_dir):
    return pairs.dedup_pairs(FX.corpus(_docs(spark, sf_dir)))


def q_holdout(spark, sf_dir):
    classified, _ = splits.by_class(_split_input(spark, sf_dir))
    return splits.holdout(classified.withColumn("split_n", F.lit(0))).select("id", "langs", "held")


def q_classified_split(spark, sf_dir):
    out = splits.classified_split(_split_input(spark, sf_dir))
    return out.select(F.col("split_n").cast("int").alias("split_n"), "label", "id")


def q_repeated_splits(spark, sf_dir):
    out = splits.split_corpus(_split_input(spark, sf_dir))
    return out.select(F.col("split_n").cast("int").alias("split_n"), "label", "id")


QUERIES.update({
    "holdout": q_holdout,
    "classified_split": q_classified_split,
    "repeated_splits": q_repeated_splits,
})


# --- translation metrics ------------------------------------------------------------
from corpusflow.operators import metrics  # noqa: E402


def _triples(spark, sf_dir):
    return FX.triples(_docs(spark, sf_dir))


def _r6(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_bleu(spark, sf_dir):
    return _r6(metrics.bleu(_triples(spark, sf_dir)))


def q_chrf(spark, sf_dir):
    return _r6(metrics.chrf(_triples(spark, sf_dir)))


def q_wer(spark, sf_dir):
    return _r6(metrics.wer(_triples(spark, sf_dir)))


def q_edit_rate(spark, sf_dir):
    return _r6(metrics.edit_rate(_triples(spark, sf_dir)))


def q_mer_wil(spark, sf_dir):
    return _r6(metrics.mer_wil(_triples(spark, sf_dir)))


def q_score_table(spark, sf_dir):
    return _r6(metrics.score(_triples(spark, sf_dir)))


def q_word_edits(spark, sf_dir):
    """MET3-MET5 on every kind of edit: words and blocks that moved, replaced, missing and added words."""
    t = metrics.score(FX.edited(_docs(spark, sf_dir)), ["kind"]).where(F.col("metric").isin("TER", "WER", "MER", "WIL"))
    return _r6(t)


QUERIES.update({
    "word_edits": q_word_edits,
    "bleu": q_bleu,
    "chrf": q_chrf,
    "wer": q_wer,
    "edit_rate": q_edit_rate,
    "mer_wil": q_mer_wil,
    "score_table": q_score_table,
})


# --- training logs -------------------------------------------------------------------
from corpusflow.operators import logs  # noqa: E402


def _runlog(spark, sf_dir):
    return FX.run_log(FX.table(spark, sf_dir, "events"))


def _train(spark, sf_dir):
    return logs.parse_train(_runlog(spark, sf_dir))


def _valid(spark, sf_dir):
    return logs.parse_valid(_runlog(spark, sf_dir))


def _clocked(spark, sf_dir):
    return logs.clock(logs.parse_lines(_runlog(spark, sf_dir)))


def q_log_parse(spark, sf_dir):
    return _r6(_train(spark, sf_dir))


def q_valid_parse(spark, sf_dir):
    return _r6(_valid(spark, sf_dir))


def q_sentences_diff(spark, sf_dir):
    return logs.sentences_diff(_train(spark, sf_dir)).select("job", "line_no", F.col("sen_diff").cast("bigint"))


def q_pause_adjusted(spark, sf_dir):
    rows = _clocked(spark, sf_dir).where(F.col("kind").isin("train", "valid"))
    return _r6(rows.select("job", "line_no", "gap", "adj_ts"))


def q_gpu_counts(spark, sf_dir):
    rows = _clocked(spark, sf_dir).where(F.col("kind") == "train")
    return rows.select("job", "line_no", F.col("gpus_now").alias("gpus"))


def q_run_duration(spark, sf_dir):
    return _r6(logs.duration_hours(_runlog(spark, sf_dir)))


def q_best_update(spark, sf_dir):
    return _r6(logs.best_update(_valid(spark, sf_dir)))


def q_scalars(spark, sf_dir):
    averaged = logs.parse_avg_logs(FX.avg_log(FX.table(spark, sf_dir, "events")))
    return _r6(logs.to_scalars(_clocked(spark, sf_dir)).unionByName(logs.avg_scalars(averaged)))


def q_avg_logs(spark, sf_dir):
    return _r6(logs.parse_avg_logs(FX.avg_log(FX.table(spark, sf_dir, "events"))).select("name", "step", "score"))


def q_bursts_batch(spark, sf_dir):
    lines = logs.parse_lines(_runlog(spark, sf_dir)).where(F.col("kind").isin("train", "valid"))
    return logs.bursts(lines.select("job", "line_no", "ts"))


QUERIES.update({
    "log_parse": q_log_parse,
    "valid_parse": q_valid_parse,
    "sentences_diff": q_sentences_diff,
    "pause_adjusted": q_pause_adjusted,
    "gpu_counts": q_gpu_counts,
    "run_duration": q_run_duration,
    "best_update": q_best_update,
    "scalars": q_scalars,
    "avg_logs": q_avg_logs,
    "bursts_batch": q_bursts_batch,
})


# --- experiments -----------------------------------------------------------------------
from corpusflow.operators import experiments as EXP  # noqa: E402


def _f6(spark, sf_dir):
    return FX.experiments(FX.table(spark, sf_dir, "events"))


def _latest(spark, sf_dir):
    return EXP.latest_scores(_f6(spark, sf_dir))


def q_latest_sessions(spark, sf_dir):
    return _r6(EXP.latest_sessions(_f6(spark, sf_dir)))


def q_list_sessions(spark, sf_dir):
    return EXP.list_sessions(_f6(spark, sf_dir), n=3)


def q_scores_matrix(spark, sf_dir):
    return _r6(EXP.scores_matrix(_latest(spark, sf_dir)))


def q_best_split(spark, sf_dir):
    return _r6(EXP.best_split(_latest(spark, sf_dir)))


def q_cv_summary(spark, sf_dir):
    return _r6(EXP.cv_summary(_latest(spark, sf_dir)))


def q_session_ids(spark, sf_dir):
    return _f6(spark, sf_dir).select("session").distinct().select("session", *EXP.parse_session_id(F.col("session")))


def _live_dirs(spark, sf_dir):
    ev = FX.table(spark, sf_dir, "events")
    return ev.where(F.col("event_type") != "error").select(F.concat(F.lit("en-cy_"), F.col("event_type")).alias("session"))


def q_live_sessions(spark, sf_dir):
    return pairs.live_sessions(_latest(spark, sf_dir), _live_dirs(spark, sf_dir)).select("session", "split_n", "metric")


def q_pending_splits(spark, sf_dir):
    latest = _latest(spark, sf_dir)
    inventory = latest.select("session").distinct().select(
        "session", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("split_n"))
    done = latest.where((F.col("metric") == "BLEU") & (F.col("score") >= 50))
    return pairs.pending_splits(inventory, done).select("session", F.col("split_n").cast("int"))


def _results(spark, sf_dir):
    """AGG3: scores, segments, sizes and duration of each (session, split)."""
    ev = FX.table(spark, sf_dir, "events")
    key = [F.concat(F.lit("en-cy_"), F.col("event_type")).alias("session"), (F.col("user_id") % 10 + 1).cast("int").alias("split_n")]
    seconds = F.col("ts").cast("timestamp").cast("double")
    hours = T.fmt_hours((F.max(seconds) - F.min(seconds)) / 3600.0)
    segs = ev.groupBy(*key).agg(F.count(F.lit(1)).alias("n_segments"))
    sizes = ev.groupBy(*key).agg(F.sum(F.octet_length("props")).alias("detail_bytes"))
    durations = ev.groupBy(*key).agg(hours.alias("hours"))
    t = stats.results_table(_latest(spark, sf_dir), segs, sizes, durations)
    return t.select("session", "split_n", "n_segments", "hours", "detail_bytes",
                    *[F.round(F.col("scores")[m], 6).alias(m.lower()) for m in EXP.SCORE_METRICS])


def q_results_table(spark, sf_dir):
    return EXP.results(_results(spark, sf_dir))


def q_results_full(spark, sf_dir):
    return EXP.results(_results(spark, sf_dir), full=True)


def q_session_states(spark, sf_dir):
    return EXP.session_states(FX.session_records(FX.table(spark, sf_dir, "events")))


QUERIES.update({
    "latest_sessions": q_latest_sessions,
    "list_sessions": q_list_sessions,
    "scores_matrix": q_scores_matrix,
    "best_split": q_best_split,
    "cv_summary": q_cv_summary,
    "session_ids": q_session_ids,
    "live_sessions": q_live_sessions,
    "pending_splits": q_pending_splits,
    "results_table": q_results_table,
    "results_full": q_results_full,
    "session_states": q_session_states,
})


# --- sources and sinks ---------------------------------------------------------------
from corpusflow.sources import bitext as BT, catalog, sinks  # noqa: E402


def _units_out(units):
    return BT.with_label(units).select("classifier", "source_lang", "source", "target_lang", "target")


def q_tmx_pairs(spark, sf_dir):
    root = FX.scratch_dir(spark, "tmx")
    FX.write_tmx_tree(FX.labelled(FX.line_pairs(_docs(spark, sf_dir))), root)
    return _units_out(BT.read_tmx(spark, root, glob=None))


def q_csv_pairs(spark, sf_dir):
    root = FX.scratch_dir(spark, "csv")
    FX.write_delimited_tree(FX.labelled(FX.line_pairs(_docs(spark, sf_dir))), root, ",")
    return _units_out(BT.read_csv_bitext(spark, root, ("en", "en")))


def q_tsv_pairs(spark, sf_dir):
    root = FX.scratch_dir(spark, "tsv")
    FX.write_delimited_tree(FX.labelled(FX.line_pairs(_docs(spark, sf_dir))), root, "\t")
    return _units_out(BT.read_csv_bitext(spark, root, ("en", "en"), sep="\t"))


def q_wordfast_pairs(spark, sf_dir):
    root = FX.scratch_dir(spark, "wf")
    FX.write_wordfast_tree(FX.labelled(FX.line_pairs(_docs(spark, sf_dir))), root)
    return _units_out(BT.read_wordfast(spark, root, glob="*.csv"))


def _manifest_urls(spark, sf_dir):
    pages = FX.table(spark, sf_dir, "pages")
    suffix = F.element_at(F.array(F.lit(".tmx.gz"), F.lit(".xz"), F.lit("")), (F.col("page_id") % 3 + 1).cast("int"))
    return pages.select(F.concat(F.regexp_replace("url", "[?#].*$", ""), suffix).alias("url"))


def q_manifest(spark, sf_dir):
    return catalog.download_manifest(_manifest_urls(spark, sf_dir), "/data/downloads")


def q_submissions(spark, sf_dir):
    root = FX.scratch_dir(spark, "subs")
    FX.write_submissions(_docs(spark, sf_dir), root)
    subs = catalog.list_submissions(spark, root, domains=("SRC1", "src2"), service="https://example.org",
                                    multi_line=False)
    return subs.select(F.col("id").cast("bigint").alias("id"), "domain", "url")


def q_split_roundtrip(spark, sf_dir):
    root = FX.scratch_dir(spark, "splits")
    corpus = sinks.write_split_texts(_split_input(spark, sf_dir), root)
    rows = splits.with_row(splits.split_corpus(corpus))
    sinks.write_splits(rows.select(splits.ROW, "split_n", "label"), f"{root}/splits")
    back = sinks.read_splits(spark, root, sinks.split_inventory(spark, f"{root}/splits"))
    return back.select(F.col("split_n").cast("int").alias("split_n"), "label", "id", "source", "target")


def q_tree_pairs(spark, sf_dir):
    """CSV and TSV files in one tree, dispatched by extension, labels by folder."""
    root = FX.scratch_dir(spark, "tree")
    f1 = FX.labelled(FX.line_pairs(_docs(spark, sf_dir)))
    FX.write_delimited_tree(f1.where(F.col("source_lang") == "en"), root, ",")
    FX.write_delimited_tree(f1.where(F.col("source_lang") != "en"), root, "\t", extension="tsv")
    return BT.read_tree(spark, root, ("en", "en")).select("classifier", "source_lang", "source", "target_lang", "target")


def q_load_corpus(spark, sf_dir):
    root = FX.scratch_dir(spark, "corpus")
    sinks.write_cleaned(FX.corpus(_docs(spark, sf_dir)), root)
    return BT.load_corpus(spark, root)


def q_aligned_export(spark, sf_dir):
    root = FX.scratch_dir(spark, "aligned")
    corpus = sinks.write_split_texts(_split_input(spark, sf_dir), f"{root}/corpus")
    sinks.export_aligned(splits.with_text(splits.split_corpus(corpus), corpus, distinct=True), f"{root}/lines")
    return sinks.read_aligned_splits(spark, f"{root}/lines")


QUERIES.update({
    "tree_pairs": q_tree_pairs,
    "load_corpus": q_load_corpus,
    "aligned_export": q_aligned_export,
    "tmx_pairs": q_tmx_pairs,
    "csv_pairs": q_csv_pairs,
    "tsv_pairs": q_tsv_pairs,
    "wordfast_pairs": q_wordfast_pairs,
    "manifest": q_manifest,
    "submissions": q_submissions,
    "split_roundtrip": q_split_roundtrip,
})


# --- requests, subword text, review, leaks, vocabulary --------------------------------
from corpusflow.operators import requests, vocab  # noqa: E402


def _conv(spark, sf_dir):
    return FX.table(spark, sf_dir, "conversations")


def q_sentence_segments(spark, sf_dir):
    return requests.sentence_rows(_conv(spark, sf_dir), ["conv_id", "turn"])


def q_reassemble_text(spark, sf_dir):
    conv = _conv(spark, sf_dir)
    sents = requests.sentence_rows(conv, ["conv_id", "turn"])
    return requests.reassemble(sents, conv, ["conv_id", "turn"])


def q_reassemble_blank(spark, sf_dir):
    """TXT11 where requests are empty, blank or null: every request is answered."""
    turn = F.col("turn") % 5
    conv = _conv(spark, sf_dir).withColumn("text", F.when(turn == 0, "").when(turn == 1, F.lit(None)).when(turn == 2, " \n ").otherwise(F.col("text")))
    return requests.reassemble(requests.sentence_rows(conv, ["conv_id", "turn"]), conv, ["conv_id", "turn"])


def q_distinct_requests(spark, sf_dir):
    asked = FX.line_pairs(_docs(spark, sf_dir)).select(
        "doc_id", "line_no", F.col("source").alias("text"), "source_lang", F.lit("cy").alias("target_lang"))
    first = pairs.distinct_requests(asked, order=("doc_id", "line_no")).withColumnsRenamed({"doc_id": "first_doc", "line_no": "first_line"})
    return pairs.answer_requests(asked, first).select("doc_id", "line_no", "first_doc", "first_line")


def q_bpe_unjoin(spark, sf_dir):
    t = _triples(spark, sf_dir)
    bpe = F.regexp_replace("ref", "(\\p{L}{3})(\\p{L}{2,})", "$1@@ $2")
    return t.select("doc_id", "line_no", T.bpe_unjoin(bpe).alias("text"))


def q_detok(spark, sf_dir):
    t = _triples(spark, sf_dir)
    tokenized = F.regexp_replace(F.lower("ref"), "([.,!?:;])", " $1")
    d = t.select("doc_id", "line_no", F.split(T.detokenize(tokenized), " ").alias("_w"))
    return d.select("doc_id", "line_no", T.detruecase(F.col("_w")).alias("text"))


def _aligned(spark, sf_dir):
    t = _triples(spark, sf_dir)
    side = lambda c: t.select("doc_id", "line_no", F.col(c).alias("text"))
    return pairs.join_triples(side("src"), side("ref"), side("hyp"), key=("doc_id", "line_no"))


def q_aligned_triples(spark, sf_dir):
    return _aligned(spark, sf_dir)


def q_review_sample(spark, sf_dir):
    return sinks.format_review(splits.review_sample(_aligned(spark, sf_dir), n=381, key=("doc_id", "line_no")),
                               key=("doc_id", "line_no"))


def q_leak_removal(spark, sf_dir):
    """Classified pairs that do not occur among the unclassified ones."""
    test, train = splits.by_class(FX.line_pairs(_docs(spark, sf_dir)))
    return pairs.ensure_unique(test, train).select("doc_id", "line_no")


def q_word_vocab(spark, sf_dir):
    return vocab.word_vocab(_docs(spark, sf_dir), 1000, lang=F.col("lang"))


def q_vocab_input(spark, sf_dir):
    corpus = sinks.write_split_texts(_split_input(spark, sf_dir), FX.scratch_dir(spark, "vocab"))
    rows = splits.with_row(splits.split_corpus(corpus).where(F.col("label") == "train")).select(splits.ROW, "split_n", "label")
    train = splits.with_text(rows, corpus, on=[splits.ROW], distinct=True)
    lines = train.select(F.explode(F.array("source", "target")).alias("text"))
    return vocab.vocab_input(lines)


QUERIES.update({
    "sentence_segments": q_sentence_segments,
    "reassemble_text": q_reassemble_text,
    "reassemble_blank": q_reassemble_blank,
    "distinct_requests": q_distinct_requests,
    "bpe_unjoin": q_bpe_unjoin,
    "detok": q_detok,
    "aligned_triples": q_aligned_triples,
    "review_sample": q_review_sample,
    "leak_removal": q_leak_removal,
    "word_vocab": q_word_vocab,
    "vocab_input": q_vocab_input,
})


# --- streaming monitor -------------------------------------------------------------------
def q_monitor_stream(spark, sf_dir):
    """LOG10-LOG12: F3 as rolled files -> stream -> carry per job -> Parquet."""
    from corpusflow.streaming import monitor
    root = FX.scratch_dir(spark, "logs")
    FX.write_log_chunks(_runlog(spark, sf_dir), f"{root}/in")
    # all files in few batches here; any number of files per batch gives the same rows
    q = monitor.monitor(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", name="*.txt", max_files=200)
    q.awaitTermination()
    return _r6(monitor.read_monitor(spark, f"{root}/out").select("job", "up", "gap", "adj_ts", "sen_diff"))


def q_monitor_appended(spark, sf_dir):
    """LOG10/LOG11: one file for each job, appended to between runs of the monitor, once in the middle of a line."""
    from corpusflow.streaming import monitor
    root = FX.scratch_dir(spark, "growing")
    lines = _runlog(spark, sf_dir)
    for share in (0.41, 1.0):
        FX.grow_logs(lines, f"{root}/in", share)
        monitor.monitor(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", follow=True).awaitTermination()
    return _r6(monitor.read_monitor(spark, f"{root}/out").select("job", "up", "gap", "adj_ts", "sen_diff"))


def _event_stream(spark, sf_dir, tag, of):
    """``of(stream)`` drained over all log lines, then over lines that come later:
    repeats of the last half hour and new lines of it, and new lines of two hours
    before the last one and earlier, which are too late."""
    from corpusflow.streaming import monitor
    root = FX.scratch_dir(spark, tag)
    lines = logs.parse_lines(_runlog(spark, sf_dir)).where(F.col("kind").isin("train", "valid")).select("job", "kind", "ts", "up")
    lines.write.parquet(f"{root}/in/part=1")
    lines = spark.read.schema(lines.schema).parquet(f"{root}/in/part=1")
    last = lines.agg(F.max("ts")).first()[0]
    recent = lines.where(F.col("ts") > F.lit(last) - F.expr("INTERVAL 30 MINUTES"))
    late = lines.where((F.col("ts") < F.lit(last) - F.expr("INTERVAL 2 HOURS")) & (F.col("up") % 50 == 0))
    stream = of(spark.readStream.schema(lines.schema).parquet(f"{root}/in"))
    monitor.drain(stream, f"{root}/out", f"{root}/ckpt")
    more = late.withColumn("up", F.col("up") + 10**9)
    if tag == "dedup":
        more = more.union(recent).union(recent.withColumn("up", F.col("up") + 2 * 10**9))
    more.write.parquet(f"{root}/in/part=2")
    dropped = monitor.drain(stream, f"{root}/out", f"{root}/ckpt")
    return spark.read.schema(stream.schema).parquet(f"{root}/out"), dropped


def q_stream_dedup(spark, sf_dir):
    """LOG10: lines seen once, with a row that counts those that came too late."""
    from corpusflow.streaming import monitor
    out, dropped = _event_stream(spark, sf_dir, "dedup", monitor.drop_seen)
    return out.select("job", "kind", "up").union(spark.createDataFrame([("-", "late", dropped)], "job string, kind string, up long"))


def q_stream_bursts(spark, sf_dir):
    """LOG13 in a stream: the bursts closed by the watermark, late lines left out."""
    from corpusflow.streaming import monitor
    return _event_stream(spark, sf_dir, "bursts", monitor.stream_bursts)[0]


QUERIES["stream_dedup"] = q_stream_dedup
QUERIES["stream_bursts"] = q_stream_bursts
QUERIES["monitor_stream"] = q_monitor_stream
QUERIES["monitor_appended"] = q_monitor_appended


# --- subword vocabulary ---------------------------------------------------------------------
def _subword_input(spark, sf_dir):
    conv = _conv(spark, sf_dir)
    return conv.select("conv_id", "turn", T.normalize(F.col("text")).alias("text"))


def q_subword_vocab(spark, sf_dir):
    return vocab.train_subwords(_subword_input(spark, sf_dir), size=1500)[0]


def q_encode_words(spark, sf_dir):
    src = _subword_input(spark, sf_dir)
    _, words, rounds = vocab.train_subwords(src, size=1500)
    enc = vocab.encode(src.select(F.concat_ws("-", "conv_id", "turn").alias("k"), "text"), words, rounds, "k")
    return enc.select("k", F.size("pieces").alias("n_pieces"), T.pieces_to_text(F.col("pieces")).alias("text"))


def q_pieces_to_text(spark, sf_dir):
    src = _subword_input(spark, sf_dir)
    _, words, rounds = vocab.train_subwords(src, size=1500)
    # another table, so that words unseen in training are encoded too
    bench = FX.table(spark, sf_dir, "benchmark").select("item_id", T.normalize(F.col("text")).alias("text"))
    enc = vocab.encode(bench, words, rounds, "item_id")
    return enc.select("item_id", T.pieces_to_text(F.col("pieces")).alias("text"))


QUERIES.update({
    "subword_vocab": q_subword_vocab,
    "encode_words": q_encode_words,
    "pieces_to_text": q_pieces_to_text,
})


# --- unigram subwords -----------------------------------------------------------------------
from corpusflow.operators import unigram  # noqa: E402


def q_unigram_seeds(spark, sf_dir):
    return unigram.seed_pieces(vocab.word_counts(_subword_input(spark, sf_dir)), 4000)


def q_unigram_expectation(spark, sf_dir):
    """Expected counts of all seed pieces in the first pass of the training."""
    words = vocab.word_counts(_subword_input(spark, sf_dir))
    seeds = {r.piece: r.freq * len(r.piece) for r in unigram.seed_pieces(words, 4000).collect()}
    model = unigram.Model(seeds, [math.log(v) - math.log(sum(seeds.values())) for v in seeds.values()])
    counts, _ = unigram.expected_counts(words, model)
    return spark.createDataFrame([(p, round(c, 3)) for p, c in counts.items()], "piece string, expected double")


def q_unigram_vocab(spark, sf_dir):
    return unigram.train(_subword_input(spark, sf_dir), size=800, seeds=4000)[0].withColumn("score", F.round("score", 3))


def q_unigram_text(spark, sf_dir):
    """Encoded by a model of another table and put together again."""
    _, model, _ = unigram.train(_subword_input(spark, sf_dir), size=800, seeds=4000)
    bench = FX.table(spark, sf_dir, "benchmark").select("item_id", T.normalize(F.col("text")).alias("text"))
    enc = unigram.encode(bench, model, ["item_id"])
    return enc.select("item_id", unigram.decode("pieces").alias("text"))


QUERIES.update({
    "unigram_seeds": q_unigram_seeds,
    "unigram_expectation": q_unigram_expectation,
    "unigram_vocab": q_unigram_vocab,
    "unigram_text": q_unigram_text,
})


# --- learnt sentence borders ----------------------------------------------------------------
from corpusflow.operators import borders  # noqa: E402


def q_abbreviation_scores(spark, sf_dir):
    return borders.abbreviation_scores(FX.shortened(_docs(spark, sf_dir)))


def q_trained_segments(spark, sf_dir):
    """TXT9: abbreviations learnt from all documents, then their sentences."""
    docs = FX.shortened(_docs(spark, sf_dir))
    return borders.trained_sentence_rows(docs, ["doc_id"], borders.abbreviations(borders.abbreviation_scores(docs)))


QUERIES.update({
    "abbreviation_scores": q_abbreviation_scores,
    "trained_segments": q_trained_segments,
})


# --- packed inputs --------------------------------------------------------------------------
def q_packed_pairs(spark, sf_dir):
    """SRC13: the units of tmx_pairs, from xz, gz and zip files."""
    root = FX.scratch_dir(spark, "packed")
    FX.write_packed_tree(FX.labelled(FX.line_pairs(_docs(spark, sf_dir))), root)
    return _units_out(BT.read_packed_tmx(spark, root))


QUERIES["packed_pairs"] = q_packed_pairs

"""The registered queries: (spark, sf_dir) -> DataFrame, one per operator."""

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import constants as K
from threadloom import schemas
from threadloom.catalog import views as V
from threadloom.functions import draws, porter, prompts
from threadloom.functions import predicates as P
from threadloom.functions import text as X
from threadloom.operators import (
    admit,
    clean,
    context,
    features,
    instruct,
    language,
    network,
    pairs,
    profile,
    router,
    sampling,
    synth,
)
from threadloom.plans import corpus
from threadloom.session import materialise, new_stage
from threadloom.sources import readers, stages, writers
from threadloom.streaming import late, streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LANGUAGES = ["de", "en", "es", "fr"]
SYSTEM_COST = 200


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _saved(spark, sf, name: str, save: Callable[[str], None]) -> str:
    """The path of a model that is fitted once per application and state of the tables."""
    return V.kept_path(spark, sf, f"model {name}", save)


def _language_model(spark, sf) -> language.LanguageModel:
    def save(path):
        language.save(language.fit(V.table(spark, sf, "documents"), "text", "lang", LANGUAGES), path)

    return language.load(spark, _saved(spark, sf, "language", save))


# --- sources ------------------------------------------------------------------
@query
def parse_ndjson(spark, sf):
    schema = schemas.T.StructType([schemas.T.StructField("k", schemas.T.LongType())])
    parsed = readers.parse_lines(V.props(spark, sf), "line", schema)
    return parsed.select("event_id", "is_valid", F.when(F.col("is_valid"), F.col("parsed.k")).alias("k"))


DUMP_SCHEMA = "id string, score bigint, subreddit string"


def _dump(spark, sf):
    schema = schemas.T.StructType.fromDDL(DUMP_SCHEMA)
    return readers.read_dump(spark, V.dump(spark, sf), schema, "position")


@query
def read_dump(spark, sf):
    """The last good line of each id of a dump of several files."""
    return pairs.latest_by_id(readers.good_rows(_dump(spark, sf)), "id", "position").drop("position")


def _split_dump(spark, sf, codec):
    schema = schemas.T.StructType.fromDDL(DUMP_SCHEMA)
    rows = readers.read_dump(spark, V.split_dump(spark, sf, codec), schema, "position", split_bytes=1 << 16)
    return pairs.latest_by_id(readers.good_rows(rows), "id", "position").drop("position")


@query
def read_dump_zstd_splits(spark, sf):
    """``read_dump`` over zstd files whose frames are read by different tasks."""
    return _split_dump(spark, sf, "zstd")


@query
def read_dump_gzip_splits(spark, sf):
    """``read_dump`` over gzip files whose members are read by different tasks."""
    return _split_dump(spark, sf, "gzip")


@query
def dump_row_counts(spark, sf):
    return profile.dump_counts(_dump(spark, sf))


@query
def read_tables(spark, sf):
    """Instruction tables of a folder, without the output that lies among them."""
    maths = instruct.math_rows(V.sourced(spark, sf))
    folder = new_stage(spark)
    for kind in ("CoT", "PoT"):
        writers.write_jsonl(maths.where(F.col("kind") == kind).drop("kind", "id"), f"{folder}/{kind}.jsonl")
    writers.write_jsonl(maths.drop("kind", "id"), f"{folder}/final.jsonl")
    writers.write_jsonl(maths.drop("kind", "id"), f"{folder}/final.jsonl.part2.jsonl")
    writers.write_jsonl(maths.drop("kind", "id"), f"{folder}/final.jsonl.part2.jsonl", mode="append")
    rows = readers.read_instruction_tables(spark, f"{folder}/*.jsonl", "final.jsonl")
    return rows.groupBy("origin").agg(F.count("*").alias("rows"), F.sum(F.length("output")).alias("chars"))


@query
def write_by_kind(spark, sf):
    """A table written in one folder per kind, and read again as one."""
    folder = new_stage(spark)
    writers.write_by_kind(instruct.math_rows(V.sourced(spark, sf)), folder, "kind")
    rows = spark.read.schema("id bigint, output string, kind string").json(folder)
    return rows.groupBy("kind").agg(F.count("*").alias("rows"), F.sum("id").alias("ids"))


@query
def rewrite_stage(spark, sf):
    """A stage polished in place."""
    path = new_stage(spark)
    stages.write_stage(V.comments(spark, sf).select("id", "body"), path)
    stages.rewrite_stage(spark, path, clean.polish_comments)
    return stages.read_stage(spark, path)


@query
def head_lines(spark, sf):
    """The first lines of one text file, as they are."""
    folder = new_stage(spark)
    lines = V.table(spark, sf, "benchmark").orderBy("item_id").limit(2 * K.HEAD_SAMPLE_LINES)
    lines.select(F.to_json(F.struct("item_id")).alias("value")).coalesce(1).write.text(folder)
    return readers.head_lines(spark, folder)


@query
def multi_source_scan(spark, sf):
    parts = {
        name: V.table(spark, sf, name).select(F.col("_metadata.file_name").alias("file"), "text")
        for name in ("documents", "benchmark", "conversations")
    }
    merged = sampling.merge_sources(parts)
    return merged.groupBy("origin", "file").agg(
        F.count("*").alias("rows"), F.sum(F.length("text")).alias("chars")
    )


def _labelled_text(spark, sf):
    doc = V.table(spark, sf, "documents")
    bench = V.table(spark, sf, "benchmark")
    chat = V.table(spark, sf, "conversations")
    return readers.labelled_text(
        {
            "general": [doc.select("doc_id", F.col("text").alias("body"))],
            "math": [bench.select(F.col("text").alias("question"), F.col("text").alias("body"))],
            "code": [chat.select(F.col("text").alias("input"), "role"), doc.select("source")],
        }
    )


@query
def labelled_text(spark, sf):
    return _labelled_text(spark, sf)


@query
def read_labelled_text(spark, sf):
    """``labelled_text`` over JSONL tables in a folder, whose columns differ and some of which are missing."""
    folder = new_stage(spark)
    doc, bench, chat = (V.table(spark, sf, name) for name in ("documents", "benchmark", "conversations"))
    tables = {
        "general": doc.select("doc_id", F.col("text").alias("body")),
        "math": bench.select(F.col("text").alias("question"), F.col("text").alias("body")),
        "code-a": chat.select(F.col("text").alias("input"), "role"),
        "code-b": doc.select("source"),
    }
    for name, rows in tables.items():
        writers.write_jsonl(rows, f"{folder}/{name}.jsonl")
    paths = {"general": [f"{folder}/general.jsonl", f"{folder}/none.jsonl"], "math": [f"{folder}/math.jsonl"], "code": [f"{folder}/code-*.jsonl"]}
    return readers.read_labelled_text(spark, paths, skip_missing=True)


@query
def head_sample(spark, sf):
    return readers.head_rows(V.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")


@query
def instruct_code(spark, sf):
    rows = V.sourced(spark, sf).select("id", "instruction", "output")
    syntax = rows.withColumn("input", F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.col("output")))
    return instruct.code_solution_rows(rows).unionByName(instruct.code_syntax_rows(syntax))


@query
def instruct_qa(spark, sf):
    rows = V.sourced(spark, sf)
    return instruct.word_problem_rows(
        rows.select("id", F.col("instruction").alias("question"), F.col("output").alias("answer"))
    )


@query
def instruct_by_source(spark, sf):
    return instruct.math_rows(V.sourced(spark, sf))


@query
def instruct_source_counts(spark, sf):
    return instruct.source_counts(V.sourced(spark, sf))


# --- predicates ---------------------------------------------------------------
def _kept_ids(name: str, keep: Callable[[], F.Column], view=V.comments):
    def run(spark, sf):
        return view(spark, sf).where(keep()).select("id")

    QUERIES[name] = run


_kept_ids("drop_tombstones", lambda: ~P.is_tombstone("body"))
_kept_ids("min_score", lambda: P.has_score("score"))
_kept_ids("drop_bots", lambda: ~P.is_bot("author"))
_kept_ids("length_range", lambda: P.length_between("body", K.BODY_LENGTH))
_kept_ids("drop_links_loose", lambda: ~P.has_loose_link("body"))
_kept_ids(
    "drop_links_strict",
    lambda: ~P.has_strict_link(P.title_and_body("title", "selftext")),
    V.submissions,
)
_kept_ids("drop_gif", lambda: ~P.has_gif("body"))
_kept_ids("title_body_rule", lambda: P.has_valid_length("title", "selftext"), V.submissions)
_kept_ids("title_recheck", lambda: P.survives_title_recheck("title"), V.submissions)


@query
def ascii_flag(spark, sf):
    return V.comments(spark, sf).select("id", P.is_ascii("body").alias("is_ascii"))


@query
def all_caps(spark, sf):
    return V.submissions(spark, sf).select(
        "id",
        P.is_all_caps(X.strip_ws("title")).alias("is_all_caps"),
        X.letter_count("title").alias("letters"),
        X.upper_count("title").alias("capitals"),
    )


@query
def english_filter(spark, sf):
    rows = V.comments(spark, sf).select("id", "body")
    return admit.keep_english(rows, F.col("body"), _language_model(spark, sf)).select("id")


@query
def english_filter_repeated_ids(spark, sf):
    """Every row is judged by its own text, also where many rows share an id."""
    rows = V.comments(spark, sf).select(F.expr("concat('r', pos % 97)").alias("id"), "body")
    return admit.keep_english(rows, F.col("body"), _language_model(spark, sf))


@query
def admit_comments(spark, sf):
    return admit.admit_comments(V.comments(spark, sf), _language_model(spark, sf)).select("id", "score")


@query
def admit_submissions(spark, sf):
    return admit.admit_submissions(V.submissions(spark, sf), _language_model(spark, sf)).select("id", "score")


@query
def default_values(spark, sf):
    posts = V.submissions(spark, sf).select(
        "id", clean.default_forum("subreddit").alias("subreddit"), "author", "score"
    )
    replies = V.comments(spark, sf).select(
        "id",
        F.coalesce("subreddit", F.lit(K.DEFAULT_FORUM)).alias("subreddit"),
        F.coalesce("author", F.lit(K.DEFAULT_AUTHOR)).alias("author"),
        F.coalesce("score", F.lit(0)).alias("score"),
    )
    return posts.unionByName(replies)


@query
def reject_reason(spark, sf):
    replies = admit.with_comment_reason(V.comments(spark, sf)).select("id", "reason")
    posts = admit.with_submission_reason(V.submissions(spark, sf)).select("id", "reason")
    return replies.unionByName(posts)


@query
def stage_counters(spark, sf):
    return admit.stage_counters(V.comments(spark, sf))


# --- text functions -----------------------------------------------------------
def _body(name: str, fn):
    def run(spark, sf):
        return V.comments(spark, sf).select("id", fn("body").alias("body"))

    QUERIES[name] = run


for _name in ("squeeze_repeats", "unescape_entities", "cut_edit", "strip_quotes", "strip_gif", "strip_ws"):
    _body(_name, getattr(X, _name))


@query
def strip_tags(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", X.strip_tags("html").alias("text"))


@query
def clean_comments(spark, sf):
    return clean.clean_comments(V.comments(spark, sf))


@query
def clean_submissions(spark, sf):
    return clean.clean_submissions(V.submissions(spark, sf))


@query
def polish_comments(spark, sf):
    return clean.polish_comments(clean.clean_comments(V.comments(spark, sf))).select("id", "body")


def _document_text(name: str, fn):
    def run(spark, sf):
        return V.table(spark, sf, "documents").select("doc_id", fn("text").alias("text"))

    QUERIES[name] = run


_document_text("normalise_text", X.normalise_text)
_document_text("normalise_spaced", X.normalise_spaced)
_document_text("tokens", lambda c: F.array_join(X.tokens(c), "|"))
_document_text(
    "remove_stopwords",
    lambda c: F.array_join(X.remove_stopwords(X.tokens(c)), " "),
)
_document_text("wrap_tool_call", X.wrap_tool_call)


@query
def tool_call_audit(spark, sf):
    return instruct.tool_call_audit(V.tool_calls(spark, sf), "output").select("id", "code", "blocked")


@query
def chatml_render(spark, sf):
    return instruct.render_chatml(instruct.math_rows(V.sourced(spark, sf))).select("id", "text")


@query
def keyword_flag(spark, sf):
    asked = F.concat("text", F.lit(" "), F.col("label"))
    rows = V.labelled(spark, sf)
    return rows.select("conv_id", "turn", prompts.mentions_technical_word(asked).alias("technical"))


# --- pairs --------------------------------------------------------------------
def _cleaned_forum(spark, sf):
    """Both tables admitted (with the language test), cleaned and polished, last row per id."""
    tables = {"comments": corpus.clean_comments, "submissions": corpus.clean_submissions}
    model = _language_model(spark, sf)
    return tuple(
        V.staged(spark, sf, f"clean {name}", lambda v=getattr(V, name), f=f: f(v(spark, sf), model, "pos"))
        for name, f in tables.items()
    )


@query
def pair_comment_reply(spark, sf):
    return pairs.comment_pairs(*_cleaned_forum(spark, sf))


@query
def pair_submission_reply(spark, sf):
    return pairs.submission_pairs(*_cleaned_forum(spark, sf))


@query
def reply_pairs(spark, sf):
    model = _language_model(spark, sf)
    return corpus.forum_pairs(V.comments(spark, sf), V.submissions(spark, sf), model, "pos")


@query
def pair_counts(spark, sf):
    return pairs.pair_counts(pairs.reply_pairs(*_cleaned_forum(spark, sf)))


@query
def top_sources(spark, sf):
    return profile.top_groups(pairs.reply_pairs(*_cleaned_forum(spark, sf)), "subreddit")


@query
def latest_by_id(spark, sf):
    events = V.table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return pairs.latest_by_id(events, "user_id", "event_id")


# --- counts and profiles ------------------------------------------------------
@query
def field_discovery(spark, sf):
    return profile.discover_fields(V.table(spark, sf, "events"), "props", "event_id")


@query
def field_discovery_many(spark, sf):
    """Fields that come and go; the first line and place of each."""
    return profile.discover_fields(V.many_fields(spark, sf), "line", "event_id")


@query
def field_overlap(spark, sf):
    def fields(df):
        json = df.select("pos", F.to_json(F.struct(*[c for c in df.columns if c != "pos"])).alias("json"))
        return profile.discover_fields(json, "json", "pos")

    return profile.field_overlap(fields(V.comments(spark, sf)), fields(V.submissions(spark, sf)))


@query
def row_counts(spark, sf):
    return profile.row_counts({name: V.table(spark, sf, name) for name in V.TABLES})


@query
def frame_profile(spark, sf):
    return profile.frame_profile(V.comments(spark, sf))


@query
def class_distribution(spark, sf):
    return sampling.class_distribution(_labelled_text(spark, sf), "category")


@query
def mix_report(spark, sf):
    return sampling.mix_report(V.table(spark, sf, "documents"), "source")


# --- sampling -----------------------------------------------------------------
def _orders(spark, sf):
    return V.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")


@query
def seeded_shuffle(spark, sf):
    return sampling.seeded_shuffle(_orders(spark, sf), "o_orderkey")


@query
def sample_exact(spark, sf):
    return sampling.sample_exact(_orders(spark, sf), "o_orderkey", 5000)


@query
def cap_rows(spark, sf):
    bought = V.table(spark, sf, "events").where("event_type = 'purchase'").select("event_id", "user_id")
    return sampling.first_rows(bought, "event_id", 1000)


@query
def cap_per_source(spark, sf):
    events = V.table(spark, sf, "events").select("event_id", "event_type")
    return sampling.cap_per_source(events, "event_type", "event_id", 1000)


@query
def balance_classes(spark, sf):
    labels = V.table(spark, sf, "labels").select("doc_id", "quality")
    return sampling.balance_classes(labels, "quality", "doc_id", 200)


@query
def train_test_split(spark, sf):
    return sampling.train_test_split(_orders(spark, sf), "o_orderkey", 20)


@query
def mixture_sample(spark, sf):
    stratum = F.create_map(
        *[F.lit(v) for pair in zip(("click", "view", "purchase", "error"), dict(K.MIX_PERCENT)) for v in pair]
    )
    events = V.table(spark, sf, "events").select(
        "event_id", F.try_element_at(stratum, F.col("event_type")).alias("stratum")
    )
    return sampling.mixture_sample(events, "stratum", "event_id", sampling.percent_quotas(1500))


@query
def mixture_with_short_sources(spark, sf):
    """A mix of exactly half of all rows, though most sources hold less than their share."""
    stratum = F.element_at(F.array(*map(F.lit, dict(K.MIX_PERCENT))), (F.col("doc_id") * 7 % 10 % 4 + 1).cast("int"))
    rows = V.table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 11 > 0, stratum).alias("stratum"))
    total = rows.count() // 2
    return sampling.exact_mixture(rows, "stratum", "doc_id", total, dict(K.MIX_PERCENT))


@query
def capped_sources(spark, sf):
    """The caps of the public sources, and how many rows each keeps."""
    events = V.table(spark, sf, "events").select("event_id", "event_type")
    parts = {name: events.where(F.col("event_type") == t) for name, t in zip(("maths", "code", "word_problems"), ("click", "view", "purchase"))}
    kept = sampling.merge_sources(corpus.capped_sources(**parts, position="event_id"))
    return kept.groupBy("origin").agg(F.count("*").alias("rows"), F.max("event_id").alias("last"))


@query
def merge_sources(spark, sf):
    return sampling.merge_sources(
        {
            "documents": V.table(spark, sf, "documents").select("text", "lang"),
            "benchmark": V.table(spark, sf, "benchmark").select("text", "item_id"),
            "conversations": V.table(spark, sf, "conversations").select("text", "role"),
        }
    )


# --- features -----------------------------------------------------------------
def _words(spark, sf, spaced=True):
    documents = V.table(spark, sf, "documents").select("doc_id", "text")
    return router.prepare(documents, "text", spaced=spaced, stem=False)


def _saved_vocabulary(spark, sf, rows):
    def save(path):
        writers.save_vocabulary(features.vocabulary(rows, "words"), path)

    return writers.load_vocabulary(spark, _saved(spark, sf, "vocabulary", save))


@query
def vocab_counts(spark, sf):
    return features.term_counts(_words(spark, sf), "words")


@query
def vocab_index(spark, sf):
    return features.vocabulary(_words(spark, sf), "words")


@query
def encode_sequences(spark, sf):
    rows = _words(spark, sf)
    encoded = features.encode_sequences(rows, "doc_id", "words", _saved_vocabulary(spark, sf, rows))
    return encoded.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query
def stem_tokens(spark, sf):
    counts = features.term_counts(_words(spark, sf), "words")
    return counts.select("term", porter.stem_token("term").alias("stem"), "tf")


@query
def stemmed_words(spark, sf):
    """Rows with their words stemmed by way of the distinct words."""
    segment = F.split(F.concat(F.lower("c_mktsegment"), F.lit(" customers buying")), " ")
    rows = V.table(spark, sf, "customer").select("c_custkey", segment.alias("words"))
    return features.stemmed(rows, "words").select("c_custkey", F.array_join("words", " ").alias("stems"))


@query
def idf_table(spark, sf):
    table = features.idf_table(_words(spark, sf, spaced=False), "words")
    return table.select("term", "df", F.round("idf", 6).alias("idf"))


@query
def ngram_terms(spark, sf):
    rows = _words(spark, sf, spaced=False)
    return rows.select("doc_id", F.size("terms").alias("n"), F.array_join("terms", "|").alias("terms"))


@query
def tfidf_vocab(spark, sf):
    return features.top_ngrams(_words(spark, sf, spaced=False), "term_words", K.MAX_VOCABULARY)


@query
def tfidf_weights(spark, sf):
    rows = _words(spark, sf, spaced=False)
    weights = features.fit_tfidf(rows, "term_words", "terms").weights(rows, "doc_id")
    return weights.select("doc_id", "term", F.round("w", 6).alias("w"))


@query
def label_encode(spark, sf):
    chat = V.labelled(spark, sf).select("conv_id", "turn", prompts.canonical_label("label").alias("label"))
    return features.encode_labels(chat, "label")


@query
def lang_profile(spark, sf):
    return language.profile(V.table(spark, sf, "documents"), "text", "lang")


def _predictions(spark, sf):
    documents = V.table(spark, sf, "documents").select("doc_id", "text", F.col("lang").alias("expected"))
    found = _language_model(spark, sf).predict(documents, "doc_id", F.col("text"))
    return documents.join(found, "doc_id")


@query
def lang_predict(spark, sf):
    documents = V.table(spark, sf, "documents").select("doc_id", "text")
    found = _language_model(spark, sf).predict(documents, "doc_id", F.col("text"))
    return found.select("doc_id", "lang", F.round("score", 2).alias("score"))


@query
def lang_holdout(spark, sf):
    """The count-based classifier fitted on four fifths of the documents, judged on the rest."""
    documents = V.table(spark, sf, "documents").select("doc_id", "text", F.col("lang").alias("expected"))
    split = sampling.train_test_split(documents, "doc_id", 20)

    def save(path):
        language.save(language.fit(split.where("part = 'train'"), "text", "expected", LANGUAGES), path)

    model = language.load(spark, _saved(spark, sf, "language of the training part", save))
    test = split.where("part = 'test'")
    found = test.select("doc_id", "expected").join(model.predict(test, "doc_id", F.col("text")), "doc_id")
    return found.groupBy("expected", F.col("lang").alias("predicted")).agg(F.count("*").alias("rows"))


@query
def router_accuracy(spark, sf):
    return router.accuracy(_predictions(spark, sf), "lang", "expected")


@query
def router_confusion(spark, sf):
    return router.confusion(V.labelled(spark, sf), X.strip_ws("predicted"), X.strip_ws("label"))


@query
def eval_rows(spark, sf):
    rows = V.labelled(spark, sf).withColumn("label", X.strip_ws("label"))
    return router.evaluation_rows(rows, "text", "predicted", "label").select("conv_id", "turn", "line")


@query
def normaliser_skew(spark, sf):
    return router.normaliser_skew(V.comments(spark, sf), "body")


def _router_rows(spark, sf):
    """Labelled texts with a key, their stemmed words and their part of the split."""

    def rows():
        parts = [
            df.select(F.concat(F.lit(f"{name}|"), *key).alias("row_id"), "text", F.lit(label).alias("category"))
            for name, label, key, df in (
                ("documents", "general", [F.col("doc_id").cast("string")], V.table(spark, sf, "documents")),
                ("benchmark", "math", [F.col("item_id").cast("string")], V.table(spark, sf, "benchmark")),
                ("conversations", "code", [F.concat_ws("|", "conv_id", "turn")], V.table(spark, sf, "conversations")),
            )
        ]
        merged = materialise(parts[0].unionByName(parts[1]).unionByName(parts[2]))
        prepared = router.prepare(merged, "text")
        return sampling.train_test_split(prepared, "row_id", 20).select("row_id", "category", "part", "term_words")

    written = V.staged(spark, sf, "router rows", rows)
    return written.withColumn("terms", X.ngram_terms("term_words"))


def _router(spark, sf):
    """The router fitted on the training part, saved and loaded."""

    def save(path):
        rows = _router_rows(spark, sf).where("part = 'train'")
        writers.save_model(router.train(rows, "category").model, path)

    return writers.load_model(_saved(spark, sf, "router", save))


@query
def train_router(spark, sf):
    """The confusion table of the held-out part."""
    scored = router.score(_router(spark, sf), _router_rows(spark, sf).where("part = 'test'"), "term_words")
    return router.confusion(scored, "label", "category")


@query
def score_router(spark, sf):
    scored = router.score(_router(spark, sf), _router_rows(spark, sf).where("part = 'test'"), "term_words")
    return scored.select("row_id", "category", "label", F.round("confidence", 6).alias("confidence"))


def _features(spark, sf, part):
    """TF-IDF vectors and class codes of a part, by the feature stages of the saved router."""
    steps = _router(spark, sf).stages
    labels = steps[-1].getLabels()
    code = F.array_position(F.array(*map(F.lit, labels)), F.col("category")) - 1
    rows = _router_rows(spark, sf).where(F.col("part") == part).withColumn("code", code)
    rows = features.with_known_terms(rows, "term_words", PipelineModel(steps[:3]))
    return PipelineModel(steps[:3]).transform(rows).select("row_id", "category", "code", "features"), labels


def _network(spark, sf) -> str:
    """The path of the network fitted on the training part."""

    def save(path):
        rows, labels = _features(spark, sf, "train")
        width = len(_router(spark, sf).stages[0].vocabulary)
        settings = network.Settings(rate=1e-2, batch_rows=2048)
        network.save(network.fit(rows, "row_id", "features", "code", width, len(labels), settings)[0], path)

    return _saved(spark, sf, "network", save)


@query
def train_network(spark, sf):
    """The confusion table of the held-out part under the feed-forward network."""
    rows, labels = _features(spark, sf, "test")
    scored = network.score(spark, _network(spark, sf), rows, "features", labels)
    return router.confusion(scored, "label", "category")


@query
def score_network(spark, sf):
    """Scores of a network with given weights over counts of letters in every document."""
    path = f"{new_stage(spark)}/fixed"
    network.save(V.fixed_network(), path)
    text = F.lower(F.coalesce("text", F.lit("")))
    shares = [F.regexp_count(text, F.lit(c)) / F.greatest(F.length(text), F.lit(1)) for c in V.LETTERS]
    rows = V.table(spark, sf, "documents").select("doc_id", array_to_vector(F.array(*shares)).alias("features"))
    scored = network.score(spark, path, rows, "features", ["a", "b", "c"])
    return scored.select("doc_id", "label", F.round("confidence", 6).alias("confidence"))


@query
def router_split(spark, sf):
    """Rows of each class in the two parts of the split."""
    return _router_rows(spark, sf).groupBy("category", "part").agg(F.count("*").alias("rows"))


# --- conversations ------------------------------------------------------------
def _dialogue(spark, sf):
    return context.dialogue(V.table(spark, sf, "conversations"))


@query
def last_n_messages(spark, sf):
    return context.last_messages(_dialogue(spark, sf)).select("conv_id", "turn", "role", "age")


@query
def render_history(spark, sf):
    return context.render_last(_dialogue(spark, sf), 4)


@query
def last_n_history(spark, sf):
    return context.last_n_history(_dialogue(spark, sf), 4)


@query
def budget_history(spark, sf):
    budget = K.CONTEXT_TOKENS - SYSTEM_COST - K.RESPONSE_RESERVE
    cost = F.length(prompts.message_line("role", "text")) + 1
    kept = context.budget_history(_dialogue(spark, sf), budget, cost)
    return kept.select("conv_id", "turn", "from_newest")


@query
def history_context(spark, sf):
    return context.history_context(_dialogue(spark, sf), SYSTEM_COST)


@query
def strip_reasoning(spark, sf):
    return context.store_answers(V.thinking(spark, sf)).select("conv_id", "turn", "text")


@query
def route_prompt(spark, sf):
    rows = V.labelled(spark, sf).select("conv_id", "turn", "label")
    return context.route_prompt(rows, "label").drop("label")


@query
def topic_forum(spark, sf):
    topic = F.concat(F.lit(" "), F.lower(draws.choose([*dict(K.FORUM_BY_TOPIC), "OTHER"], F.col("doc_id") % 7)))
    rows = V.table(spark, sf, "documents").select("doc_id", topic.alias("topic"))
    return rows.withColumn("forum", prompts.forum_of_topic("topic"))


@query
def forum_prompt(spark, sf):
    prompt = prompts.forum_prompt("forum", "context")
    return V.labelled(spark, sf).select("conv_id", "turn", prompt.alias("prompt"))


@query
def math_prompt(spark, sf):
    h = draws.draw("flags", "doc_id")
    names = ("latex", "mcq", "code", "explain", "comments", "asymptote")
    flags = V.table(spark, sf, "documents").select(
        "doc_id", *[(F.shiftright(h, i) % 2 == 1).alias(n) for i, n in enumerate(names)]
    )
    return flags.withColumn("prompt", prompts.math_prompt(*names))


def _requests(rows, profile="v2"):
    requests = context.request_rows(rows, F.col("label"), F.col("forum"), SYSTEM_COST, profile)
    parts = requests.select("conv_id", "turn", "route", "temperature", F.posexplode("messages"))
    return parts.select(
        "conv_id", "turn", "route", "temperature", F.col("pos").alias("place"), "col.role", "col.content"
    )


@query
def build_messages(spark, sf):
    return _requests(context.dialogue(V.labelled(spark, sf)))


@query
def build_messages_v1(spark, sf):
    return _requests(context.dialogue(V.labelled(spark, sf)), "v1")


@query
def build_messages_reasoning(spark, sf):
    return _requests(context.dialogue(V.labelled(spark, sf)), "reasoning")


@query
def cleaned_history(spark, sf):
    """The budgeted history over turns that were stored without their reasoning."""
    stored = context.store_answers(context.dialogue(V.thinking(spark, sf)))
    return context.history_context(stored, SYSTEM_COST)


# --- streams ------------------------------------------------------------------
def _arriving(spark, rows, *by):
    """Rows as a stream that takes two of six files at a time, dealt by a hash of ``by``; and a folder for its results."""
    folder = new_stage(spark)
    rows.repartition(6, F.xxhash64(*by)).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    return stream, folder


def _appended(spark, stream, folder):
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out")
    streams.run_available(writer, f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


@query
def stream_clean(spark, sf):
    """ASCII comments admitted and cleaned as they arrive."""
    stream, folder = _arriving(spark, V.comments(spark, sf), "id")
    return _appended(spark, streams.clean_ascii_stream(stream), folder)


@query
def stream_route(spark, sf):
    rows = V.labelled(spark, sf).select("conv_id", "turn", "label")
    stream, folder = _arriving(spark, rows, "conv_id", "turn")
    return _appended(spark, streams.route_stream(stream, "label").drop("label"), folder)


@query
def stream_late_history(spark, sf):
    """The rolling history of messages whose turns arrive in any order."""
    streams.keep_state_in_rocksdb(spark)
    rows = V.table(spark, sf, "conversations").withColumn("sent", F.timestamp_seconds(F.col("turn") * 60 + 86_400))
    stream, folder = _arriving(spark, rows, "conv_id", "turn")
    found = late.late_history_stream(stream, "sent", "3650 days", 86_400)
    streams.run_available(late.write_batches(found, f"{folder}/out"), f"{folder}/checkpoint")
    return late.latest(spark, f"{folder}/out", "conv_id", "turn", version="revision").drop("revision")


@query
def stream_latest_by_id(spark, sf):
    """The last event of each user, of events that arrive in any order."""
    streams.keep_state_in_rocksdb(spark)
    events = V.table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    stream, folder = _arriving(spark, events.withColumn("seen", F.timestamp_seconds(F.col("event_id") + 86_400)), "event_id")
    found = late.latest_rows_stream(stream, "user_id", "event_id", "seen", "36500 days", 86_400).drop("seen")
    streams.run_available(late.write_batches(found, f"{folder}/out"), f"{folder}/checkpoint")
    return late.latest(spark, f"{folder}/out", "user_id", version="event_id")


# --- generated rows -----------------------------------------------------------
@query
def synth_arithmetic(spark, sf):
    return synth.arithmetic(V.table(spark, sf, "orders"), "o_orderkey")


@query
def synth_arithmetic_forms(spark, sf):
    return synth.arithmetic_forms(V.table(spark, sf, "orders"), "o_orderkey")


@query
def synth_templates(spark, sf):
    keywords = V.table(spark, sf, "part").select(F.col("p_name").alias("keyword")).distinct()
    code = synth.keyword_sentences(keywords, "keyword", K.CODE_KEYWORD_TEMPLATES, seed="code")
    maths = synth.keyword_sentences(keywords, "keyword")
    return sampling.merge_sources({"math": maths, "code": code})


@query
def synth_snippets(spark, sf):
    return synth.snippets(V.table(spark, sf, "part"), "p_partkey")


@query
def repeat_phrases(spark, sf):
    return synth.repeat_phrases(V.table(spark, sf, "benchmark").select("item_id", "text"))


@query
def word_dropout(spark, sf):
    return synth.word_dropout(V.table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")


@query
def build_test_set(spark, sf):
    cases = V.table(spark, sf, "benchmark").select(
        F.concat(F.lit("g"), F.col("item_id").cast("string")).alias("row_id"),
        F.lit("general").alias("category"),
        F.col("text").alias("input"),
    )
    rows = synth.build_test_set(cases, V.table(spark, sf, "part"), "p_partkey")
    return sampling.seeded_shuffle(rows, "row_id")


@query
def training_text(spark, sf):
    forum = pairs.reply_pairs(*_cleaned_forum(spark, sf)).drop("pair_type")
    maths = instruct.math_rows(V.sourced(spark, sf))
    return corpus.training_text(forum, {"maths": maths}, 300).select("row_key", "rank", "text")

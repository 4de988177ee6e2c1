"""Chat, question-answer and preference records as training rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone import shared
from quarrystone.functions.content import content_text, reference_text
from quarrystone.schemas import DPO_METADATA, SFT_METADATA

CONTEXT_ROLES = ("system", "developer")


def sparse(rows: DataFrame, fields: tuple[str, ...]) -> list[Column]:
    """Those of the metadata fields that the records have."""
    return [F.col(f) for f in fields if f in rows.columns]


def _text(rows: DataFrame, name: str) -> Column:
    """A column as content text: strings as they are, VARIANT by its JSON."""
    kind = dict(rows.dtypes).get(name)
    if kind is None:
        return F.lit(None).cast("string")
    if kind == "string":
        return F.col(name)
    value = F.when(F.col(name).isNotNull(), F.to_json(name))
    return F.when(value.isNotNull(), content_text(value))


def dereference(refs: DataFrame, files: DataFrame, folders: list[str], strict: bool = True) -> DataFrame:
    """``refs(ref)`` plus ``value``, from the first existing file among the ref under each folder.

    ``files(path, content)`` is the set of referenced texts; JSON files give what ``reference_text`` says. A miss fails with all
    paths tried when ``strict``, else is null.
    """
    absolute = F.col("ref").startswith("/")
    tried = F.when(absolute, F.array("ref")).otherwise(F.array(*(F.concat(F.lit(f.rstrip("/") + "/"), F.col("ref")) for f in folders)))
    wanted = refs.select("ref").distinct().select("ref", tried.alias("tried"))
    found = wanted.select("ref", F.posexplode("tried").alias("rank", "path")).join(files, "path")
    best = found.groupBy("ref").agg(F.min_by(F.struct("path", "content"), "rank").alias("best"))
    rows = wanted.join(best, "ref", "left")
    is_json = F.lower("best.path").rlike(r"\.jsonl?$")
    value = F.coalesce(reference_text(F.when(is_json, F.col("best.content"))), F.col("best.content"))
    if strict:
        missing = F.raise_error(F.concat(F.lit("no file for "), F.col("ref"), F.lit("; tried "), F.array_join("tried", ", ")))
        value = F.when(F.col("best").isNull(), missing).otherwise(value)
    return refs.join(rows.select("ref", value.alias("value")), "ref", "left")


def resolve_messages(records: DataFrame, files: DataFrame, folders: list[str]) -> DataFrame:
    """``messages`` with every content_ref replaced by its file's text; order kept."""
    flat = records.select("record_id", F.posexplode_outer("messages").alias("at", "m"))
    refs = flat.filter("m.content_ref IS NOT NULL AND m.content IS NULL").select(F.col("m.content_ref").alias("ref"))
    values = dereference(refs.distinct(), files, folders)
    joined = flat.join(values.withColumnRenamed("ref", "_ref"), F.col("m.content_ref") == F.col("_ref"), "left")
    message = F.struct("at", F.col("m.role").alias("role"), F.coalesce("m.content", "value").alias("content"))
    # A record's messages: bounded by the record.
    back = joined.groupBy("record_id").agg(F.sort_array(F.collect_list(message)).alias("messages"))
    return records.drop("messages").join(back, "record_id")


def route_messages(messages: Column) -> dict[str, Column]:
    """context, question and answer from ordered messages; unknown roles ask, empty contents go."""
    said = F.filter(messages, lambda m: F.coalesce(m["content"], F.lit("")) != "")
    role = lambda m: F.coalesce(m["role"], F.lit("user"))

    def join(keep) -> Column:
        return F.array_join(F.transform(F.filter(said, keep), lambda m: m["content"]), "\n\n")

    return {
        "context": join(lambda m: role(m).isin(*CONTEXT_ROLES)),
        "question": join(lambda m: ~role(m).isin(*CONTEXT_ROLES, "assistant")),
        "answer": join(lambda m: role(m) == "assistant"),
    }


def sft_rows(records: DataFrame, strict: bool = True) -> DataFrame:
    """context, question, answer and the metadata that exists. Records of question-answer form come first,
    then chats, then prompt and answer under other names. Where not ``strict``, ``error`` says what is wrong
    and nothing fails."""
    columns = set(records.columns)
    pick = lambda *names: F.coalesce(*(F.nullif(_text(records, n), F.lit("")) for n in names))
    qa = {n: _text(records, n) for n in ("context", "question", "answer")}
    is_qa = F.lit({"context", "question", "answer"} <= columns)
    if {"context", "question", "answer"} <= columns:
        is_qa = F.col("context").isNotNull() & F.col("question").isNotNull() & F.col("answer").isNotNull()
    chat = route_messages(F.col("messages")) if "messages" in columns else dict.fromkeys(qa, F.lit(None).cast("string"))
    is_chat = F.col("messages").isNotNull() if "messages" in columns else F.lit(False)
    plain = {"context": F.lit(""), "question": pick("prompt", "instruction", "question"), "answer": pick("answer", "output", "completion")}
    out = {n: F.when(is_qa, qa[n]).when(is_chat, chat[n]).otherwise(plain[n]) for n in qa}
    wrong = (
        F.when(is_qa, None)
        .when(is_chat & (chat["answer"] == ""), "no assistant answer")
        .when(is_chat & (chat["context"] == "") & (chat["question"] == ""), "no prompt content")
        .when(~is_chat & (plain["question"].isNull() | plain["answer"].isNull()), "neither messages nor a question with an answer")
    )
    rows = records.select(*sparse(records, SFT_METADATA), *(c.alias(n) for n, c in out.items()), wrong.alias("error"))
    return _strictly(rows) if strict else rows


def _strictly(rows: DataFrame) -> DataFrame:
    name = F.coalesce(F.col("record_id"), F.lit("<unknown>")) if "record_id" in rows.columns else F.lit("<unknown>")
    fail = F.raise_error(F.concat(F.lit("record "), name, F.lit(": "), F.col("error")))
    first = rows.columns[0]
    return rows.withColumn(first, F.when(F.col("error").isNotNull(), fail.cast(dict(rows.dtypes)[first])).otherwise(F.col(first))).drop("error")


def dpo_rows(records: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """prompt, chosen, rejected: the field, else the text behind ``<field>_ref`` in ``values(ref, value)``.

    A list-valued prompt has no place in a string column: it is its JSON, and ``<field>_is_list`` says so.
    """
    rows = records
    for field in ("prompt", "chosen", "rejected"):
        own = _text(records, field)
        kind = dict(records.dtypes).get(field)
        listed = F.coalesce(F.schema_of_variant(field).startswith("ARRAY"), F.lit(False)) if kind == "variant" else F.lit(False)
        value = F.when(listed, F.to_json(field)).otherwise(own) if kind == "variant" else own
        if f"{field}_ref" in records.columns and values is not None:
            looked = values.select(F.col("ref").alias(f"{field}_ref"), F.col("value").alias(f"_{field}"))
            rows = rows.join(looked, f"{field}_ref", "left")
            value = F.coalesce(value, F.col(f"_{field}"))
        rows = rows.withColumns({f"_{field}_text": value, f"{field}_is_list": listed})
    texts = [F.col(f"_{f}_text").alias(f) for f in ("prompt", "chosen", "rejected")]
    return rows.select(*sparse(records, DPO_METADATA), *texts, *(f"{f}_is_list" for f in ("prompt", "chosen", "rejected")))


def preference_pairs(candidates: DataFrame, task: list[str], score: str, item: str, margin: float = 0.0) -> DataFrame:
    """The best and the worst usable candidate of every task whose scores lie more than ``margin`` apart.

    Candidates with an error don't count, equal scores go by item. Pairing all of a task's candidates would be
    quadratic; its two ends are the widest pair.
    """
    usable = candidates.filter(F.col("error").isNull()) if "error" in candidates.columns else candidates
    end = F.struct(F.col(score).alias("score"), F.col(item).alias("item"))
    ends = usable.groupBy(*task).agg(F.max(end).alias("hi"), F.min(end).alias("lo"), F.count("*").alias("candidates"))
    wide = ends.filter(F.col("hi.score") - F.col("lo.score") > margin)
    return wide.select(*task, F.col("hi.item").alias("chosen"), F.col("lo.item").alias("rejected"), F.col("hi.score").alias("chosen_score"), F.col("lo.score").alias("rejected_score"), "candidates")


def convert(records: DataFrame, kind: str, **options) -> DataFrame:
    """The transform registered for ``kind``."""
    return CONVERTERS[kind](records, **options)


CONVERTERS = {"sft": sft_rows, "dpo": dpo_rows}


def exact_dedup(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per distinct text digest: the smallest key and the number of copies."""
    return documents.groupBy(F.sha2(F.col(text), 256).alias("text_sha256")).agg(F.min(key).alias(key), F.count("*").alias("copies"))


ANCHOR = 64
SLICE_BYTES = 32 << 20
SLICES_A_PASS = 4
_AUTOMATA: dict[str, tuple] = {}


def _automaton(name: str, texts: list[str]) -> tuple:
    """An automaton over the first ``ANCHOR`` characters of ``texts``; for each anchor the lengths and the set of its texts. Kept for the worker's next tasks."""
    import ahocorasick

    if name not in _AUTOMATA:
        groups: dict[str, set[str]] = {}
        for text in texts:
            groups.setdefault(text[:ANCHOR], set()).add(text)
        automaton = ahocorasick.Automaton()
        for anchor, whole in groups.items():
            automaton.add_word(anchor, (len(anchor), sorted({len(t) for t in whole}), whole))
        automaton.make_automaton()
        if len(_AUTOMATA) >= SLICES_A_PASS:
            _AUTOMATA.clear()
        _AUTOMATA[name] = (automaton,)
    return _AUTOMATA[name]


def _without(name: str, texts: Broadcast, column: str):
    def holds(automaton, text: str) -> bool:
        for last, (size, lengths, whole) in automaton.iter(text):
            begin = last - size + 1
            if any(text[begin : begin + n] in whole for n in lengths if begin + n <= len(text)):
                return True
        return False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (automaton,) = _automaton(name, texts.value)
        for batch in batches:
            given = batch.column(batch.schema.get_field_index(column))
            yield batch.filter(pa.array([(t := x.as_py()) is None or not holds(automaton, t) for x in given], pa.bool_()))

    return run


def holdout_exclusion(documents: DataFrame, held: DataFrame, identities: list[list[str]] = [], text: str = "text") -> DataFrame:  # noqa: B006
    """Documents that hold none of the held-out texts, whole and character for character, and share none of their ``identities``.

    The held texts (an evaluation set) become automata, which run over the documents where they lie: no window of the corpus is
    shuffled and no two texts are joined. Their bytes are counted first and dealt into slices of some ``SLICE_BYTES``, of which a task holds one automaton
    each; more than ``SLICES_A_PASS`` slices take further passes over what is left, so a held set of any size is looked for whole. An identity is a list of
    columns, such as a task's; documents with the same values as a held row go, nulls match nothing. Null texts stay.
    """
    spark = documents.sparkSession
    out = documents
    for columns in identities:
        out = out.join(held.select(*columns).distinct(), columns, "left_anti")
    golds = held.select(F.col(text).alias("gold")).filter(F.col("gold") != "").distinct()
    size = golds.agg(F.sum(F.octet_length("gold"))).first()[0] or 0
    slices = -(-size // SLICE_BYTES)
    for number in range(slices):
        part = golds.filter(F.pmod(F.xxhash64("gold"), F.lit(slices)) == number) if slices > 1 else golds
        # A slice of bounded bytes.
        texts = spark.sparkContext.broadcast([r["gold"] for r in part.toLocalIterator()])
        if number and number % SLICES_A_PASS == 0:
            out = shared.stored(out, "held")
        out = out.mapInArrow(_without(uuid.uuid4().hex, texts, text), out.schema)
    return out

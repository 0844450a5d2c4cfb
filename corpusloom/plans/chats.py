"""Chat, benchmark and parallel-text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import conversations as C
from corpusloom.operators import filters, instructions
from corpusloom.plans.registry import query, table

_TRIM = "trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def chats(spark, sf):
    return C.gathered(table(spark, sf, "conversations"))


@query(f"select conv_id, md5('<s>' || string_agg('<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) || {_TRIM} || '<|eot_id|>', '' order by turn)) as text from conversations group by conv_id")
def chat_rendered(spark, sf):
    return chats(spark, sf).select("conv_id", F.md5(C.rendered(F.col("messages"))).alias("text"))


@query("""select doc_id, md5('<s><|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || 'Summarise' || case when doc_id % 2 = 0 then chr(10) || trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) else '' end || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) || source || '<|eot_id|>') as text from documents""")
def instruction_chats(spark, sf):
    chat = C.as_chat(F.lit("Summarise"), F.col("source"), F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(""))
    return table(spark, sf, "documents").select("doc_id", F.md5(C.rendered(chat)).alias("text"))


@query("select conv_id, string_agg(case when role = 'user' then 'user' else 'assistant' end, ',' order by turn) as roles from conversations group by conv_id")
def foreign_chats(spark, sf):
    foreign = F.transform("messages", lambda m: F.struct(F.when(m["role"] == "user", "human").otherwise(m["role"]).alias("from"), m["content"].alias("value")))
    rows = chats(spark, sf).select("conv_id", C.from_foreign(foreign).alias("m"))
    return rows.select("conv_id", F.array_join(F.transform("m", lambda m: m["role"]), ",").alias("roles"))


@query("select doc_id from documents where doc_id % 6 not in (0, 2, 3)")
def keyword_filter(spark, sf):
    """Drop texts that name a model as a whole word."""
    said = F.concat("text", F.when(F.col("doc_id") % 6 == 0, " As ChatGPT, I").when(F.col("doc_id") % 6 == 1, " ChatGPTs").when(F.col("doc_id") % 6 == 2, " (gpt-4)").when(F.col("doc_id") % 6 == 3, " gpt-3x5 MISTRAL.").otherwise(" mistrals"))
    return table(spark, sf, "documents").filter(~filters.names_a_model(said)).select("doc_id")


@query("select conv_id from conversations group by conv_id having not bool_or(role = 'assistant' and conv_id % 3 = 0)")
def conversation_keyword_filter(spark, sf):
    """Drop conversations in which an assistant names a model; users may."""
    rows = table(spark, sf, "conversations").withColumn("text", F.concat("text", F.when((F.col("conv_id") % 3 == 0) | (F.col("role") == "user"), " Claude").otherwise("")))
    return C.gathered(rows).filter(filters.conversation_is_clean(F.col("messages"))).select("conv_id")


@query("select conv_id from (select conv_id, row_number() over (partition by k order by conv_id) as r from (select conv_id, string_agg(role || chr(1) || text, chr(2) order by turn) as k from conversations group by conv_id)) where r > 1")
def repeated_conversations(spark, sf):
    from corpusloom.operators.dedup import repeats

    return repeats(chats(spark, sf), F.sha2(F.to_json("messages"), 256), "conv_id").select("conv_id")


@query("select item_id, 'A' as answer, split_part(text, ' ', 1) as positive, 3::bigint as negatives from benchmark")
def benchmark_items(spark, sf):
    """Items with four choices, the answer by label or by index."""
    w = F.split("text", " ")
    choices = F.array(F.get(w, F.lit(0)), F.lit("two"), F.lit("three"), F.lit("four"))
    answer = F.when(F.col("item_id") % 2 == 0, "A").otherwise("0")
    item = C.benchmark_item(F.col("text"), choices, F.array(*map(F.lit, "ABCD")), answer, F.col("item_id"), show_choices=False)
    rows = C.labelled(table(spark, sf, "benchmark").select("item_id", item.alias("i")).select("item_id", "i.*"))
    return rows.select("item_id", F.lit("A").alias("answer"), F.element_at("positive", 1).alias("positive"), F.size("negative").cast("long").alias("negatives"))


@query("select item_id, md5(ltrim(text || '. Here are the choices: A: x. B: y.', ' .')) as prompt, 'B: y.' as positive from benchmark where item_id % 3 <> 0")
def benchmark_prompts(spark, sf):
    """Items whose prompt lists the choices; unlabelled ones drop out."""
    answer = F.when(F.col("item_id") % 3 != 0, F.lit("B")).otherwise(F.lit(""))
    item = C.benchmark_item(F.col("text"), F.array(F.lit("x"), F.lit("y")), F.array(F.lit("A"), F.lit("B")), answer, F.col("item_id"), show_choices=True)
    rows = C.labelled(table(spark, sf, "benchmark").select("item_id", item.alias("i")).select("item_id", "i.*"))
    # only the separators of the list at the end; the item's own line breaks stay
    flat = F.regexp_replace("prompt", r"(\. Here are the choices:)[ \n](A: x\.)[ \n](B: y\.)\z", "$1 $2 $3")
    return rows.select("item_id", F.md5(flat).alias("prompt"), F.element_at("positive", 1).alias("positive"))


@query("select item_id, md5(ltrim(regexp_replace(regexp_replace(t, '\\.?\\s*\\[[a-zA-Z]*\\]', '.', 'g'), '^[ .]+', ''), '')) as text from (select item_id, ' [header] ' || replace(text, ',', '. [title]') as t from benchmark)")
def annotations_dropped(spark, sf):
    from corpusloom.functions.text import drop_annotations

    t = F.concat(F.lit(" [header] "), F.replace("text", F.lit(","), F.lit(". [title]")))
    return table(spark, sf, "benchmark").select("item_id", F.md5(drop_annotations(t)).alias("text"))


@query("select doc_id, md5('### Question' || chr(10) || source || chr(10) || '### Answer' || chr(10) || text) as text from documents")
def question_templates(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(F.format_string("### Question\n%s\n### Answer\n%s", "source", "text")).alias("text"))


@query("select lang, doc_id from documents where lang in ('en', 'fr') and source not in ('src1', 'src2') and starts_with(source, 'src1')")
def membership_filters(spark, sf):
    left = spark.createDataFrame([("src1",), ("src2",)], "source string")
    rows = table(spark, sf, "documents").filter(F.col("lang").isin("en", "fr") & F.col("source").startswith("src1"))
    return rows.join(left, "source", "left_anti").select("lang", "doc_id")


@query()
def parallel_texts(spark, sf):
    """Each turn of even number beside the next; a last one alone stands beside itself."""
    rows = table(spark, sf, "conversations").groupBy("conv_id", F.floor(F.col("turn") / 2).alias("pair")).agg(F.min_by("text", "turn").alias("a"), F.max_by("text", "turn").alias("b"))
    both = C.parallel_text(F.col("a"), F.col("b"), F.lit("en"), F.lit("fr"), F.concat_ws("/", "conv_id", "pair"))
    return rows.select("conv_id", "pair", both.alias("p")).select("conv_id", "pair", F.md5("p.text").alias("text"), "p.lang_1", "p.lang_2")


@query()
def translation_chats(spark, sf):
    """Aligned texts, here those of benchmark and the same reversed, as translation chats."""
    pair = F.element_at(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in PAIRS]), F.pmod("item_id", F.lit(len(PAIRS))).cast("int") + 1)
    rows = table(spark, sf, "benchmark").select(F.col("text").alias("text_1"), F.reverse("text").alias("text_2"), pair["a"].alias("lang_1"), pair["b"].alias("lang_2"), F.col("item_id").alias("key"))
    chats = instructions.translation_chats(rows, spark.createDataFrame(instructions.TEMPLATES, "language string, text string"))
    return chats.select(F.col("key").alias("item_id"), F.md5(C.rendered(F.col("messages"))).alias("text"), F.size("messages").alias("turns"))


PAIRS = [("en", "fr"), ("fr", "it"), ("de", "es")]
_ROWS = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in instructions.TEMPLATES)


@query(f"""with t as (select language, text, case when contains(text, '<from>') then 'both' when contains(text, '<to>') then 'to' else 'none' end as kind, 1 / (length(text) * length(text))::double as w from (values {_ROWS}) v(language, text)),
r as (select *, sum(w) over (partition by language, kind order by text rows unbounded preceding) / sum(w) over (partition by language, kind) as hi, row_number() over (partition by language, kind order by text desc) as l, coalesce(sum(w) over (partition by language, kind order by text rows between unbounded preceding and 1 preceding) / sum(w) over (partition by language, kind), 0) as lo from t),
d as (select doc_id, lang, ('0x' || substr(sha256('template:' || doc_id), 1, 8))::bigint / 4294967296.0::double as u, ('0x' || substr(sha256('kind:' || doc_id), 1, 8))::bigint / 4294967296.0::double as v from documents)
select doc_id, lang, kind, text as template from d join r on lang = language and kind = case when v < 0.4 then 'both' when v < 0.9 then 'to' else 'none' end and u >= lo and (u < hi or l = 1)""")
def templates_drawn(spark, sf):
    """A template for each document in its language, by weight: a join on ranges."""
    ranges = instructions.with_ranges(spark.createDataFrame(instructions.TEMPLATES, "language string, text string"))
    kind = instructions.one_of("kind", F.col("doc_id"), ["both", "to", "none"], [0.4, 0.5, 0.1])
    docs = table(spark, sf, "documents").select("doc_id", "lang", kind.alias("kind"))
    return instructions.drawn(docs, ranges, "lang", "kind", "doc_id").select("doc_id", "lang", "kind", "template")

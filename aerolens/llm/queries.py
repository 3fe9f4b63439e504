"""The corpus queries and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolens.llm.chat_format import chat_windows, read_back
from aerolens.llm.common import documents
from aerolens.llm.conversation_repair import repair_report
from aerolens.llm.fingerprints import fingerprints
from aerolens.llm.language_id import held_out, language_id
from aerolens.llm.line_dedup import line_dedup
from aerolens.llm.mixing import mix
from aerolens.llm.ngram_jaccard import ngram_jaccard
from aerolens.llm.odd_sketches import odd_sketch_components
from aerolens.llm.packing import pack
from aerolens.llm.periodic_runs import periodic_runs
from aerolens.llm.quality_rules import quality_rules
from aerolens.llm.suffix_dedup import suffix_dedup
from aerolens.llm.token_counts import token_prefixes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


SPACE_SQL = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FOLD_SQL = f"translate({{0}}, '{UPPER}', '{UPPER.lower()}')"


@query(f"""
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), lines as (
  select doc_id, unnest(lines) as line, unnest(range(len(lines))) as pos from split
), keys as (
  select doc_id, pos, line, {FOLD_SQL.format(f"trim(line, {SPACE_SQL})")} as key from lines
), first as (
  select key, min(doc_id) as first_doc from keys where length(key) >= 10
  group by key having count(distinct doc_id) >= 2
), marked as (
  select k.doc_id, k.pos, k.line, coalesce(f.first_doc <> k.doc_id, false) as dropped
  from keys k left join first f on k.key = f.key
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shared by documents are kept in the smallest doc_id only."""
    return line_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


#: Documents of more tokens are over the limit.
TOKEN_LIMIT = 2048


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text, and the code points that fit the limit, from its table of all prefixes."""
    counts = token_prefixes(documents(spark, sf_dir), keep_prefixes=False, budget=TOKEN_LIMIT)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language_id(documents(spark, sf_dir)).drop("n_grams").withColumn("held_out", held_out())


@query()
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality_rules(documents(spark, sf_dir))


@query()
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash of every text and of its edited text."""
    return fingerprints(documents(spark, sf_dir))


@query()
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents by four-word shingles, at a Jaccard similarity of 85 percent."""
    return ngram_jaccard(documents(spark, sf_dir), words=4, percent=85)


@query()
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated 200-byte strings."""
    found = suffix_dedup(documents(spark, sf_dir))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


#: The tree of op3: a source's domain is its first four characters.
LEVELS = {"domain": "substring(source, 1, 4)", "lang": "lang", "source": "source"}
WEIGHTS = {"domain": {"src0": 2}, "lang": {"en": 3, "de": 2}}
MIX_PERCENT, MIX_EPOCHS = 60, 2
N_TOKENS_SQL = "len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as n_tokens"


def _mixing_sql() -> str:
    names = list(LEVELS)
    parts = [
        f"rows as (select doc_id, {', '.join(f'{sql} as {n}' for n, sql in LEVELS.items())}, {N_TOKENS_SQL} from documents)",
        f"leaves as (select {', '.join(names)}, sum(n_tokens)::hugeint as supply from rows group by all)",
        f"given0 as (select least(sum(supply) * {MIX_PERCENT} // 100, sum(supply) * {MIX_EPOCHS})::hugeint as budget from leaves)",
    ]
    for k, name in enumerate(names, 1):
        path, parent = ", ".join(names[:k]), names[: k - 1]
        inside = f"partition by {', '.join(parent)}" if parent else ""
        same = " and ".join(f"a.{c} is not distinct from u.{c}" for c in parent) or "true"
        weight = " ".join(f"when {name} = '{v}' then {w}" for v, w in WEIGHTS.get(name, {}).items())
        weight = f"case {weight} else 1 end" if weight else "1"
        order = f"{inside} order by capacity::double / weight::double, {name} nulls first rows between"
        parts += [
            f"a{k} as (select {path}, sum(supply) * {MIX_EPOCHS} as capacity, ({weight})::hugeint as weight from leaves group by {path})",
            f"b{k} as (select a.*, u.budget as given from a{k} a join given{k - 1} u on {same})",
            f"""c{k} as (select *, coalesce(sum(capacity) over ({order} unbounded preceding and 1 preceding), 0) as full_before,
              sum(weight) over ({order} current row and unbounded following) as weight_left from b{k})""",
            f"""d{k} as (select *, max((capacity * weight_left > weight * (given - full_before))::int)
              over ({order} unbounded preceding and current row) as open from c{k})""",
            f"""e{k} as (select *, given - sum(case when open = 0 then capacity else 0 end) over ({inside}) as rest,
              sum(case when open = 1 then weight else 0 end) over ({inside}) as shared from d{k})""",
            f"f{k} as (select *, case when open = 1 then (weight * rest) // shared else capacity end as share from e{k})",
            f"""given{k} as (select {path}, (share + case when open = 1 and row_number() over (
              partition by {', '.join([*parent, 'open'])} order by {name} nulls first
              ) <= given - sum(share) over ({inside}) then 1 else 0 end)::hugeint as budget from f{k})""",
        ]
    same = " and ".join(f"{{0}}.{c} is not distinct from g.{c}" for c in names)
    parts += [
        f"""plan as (select g.*, coalesce(g.budget // nullif(l.supply, 0), 0) as full_epochs,
          g.budget - coalesce(g.budget // nullif(l.supply, 0), 0) * l.supply as rest
          from given{len(names)} g join leaves l on {same.format('l')})""",
        f"""drawn as (select r.*, g.budget, g.full_epochs, g.rest,
          md5('1:' || g.full_epochs::varchar || ':' || r.doc_id::varchar) as draw
          from rows r join plan g on {same.format('r')})""",
        f"""totals as (select *, sum(n_tokens) over (partition by {', '.join(names)} order by draw, n_tokens
          rows between unbounded preceding and current row) as total from drawn)""",
    ]
    return f"""with {', '.join(parts)}
      select doc_id, {', '.join(names)}, n_tokens, budget::bigint as budget,
        (full_epochs + (total <= rest)::int)::bigint as copies from totals"""


@query(_mixing_sql())
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document enters a mixture of 60 percent of all words."""
    return mix(
        documents(spark, sf_dir), levels=LEVELS, weights=WEIGHTS, percent=MIX_PERCENT, epochs=MIX_EPOCHS
    ).drop("row")


BUCKETS, BATCH_TOKENS = 8, 16_384


def _packing_sql() -> str:
    step = "(1::bigint << greatest(0, len(bin(n_tokens)) - 8)::int)"
    parts = [
        f"rows as (select doc_id, {N_TOKENS_SQL} from documents)",
        f"rounded as (select *, ((n_tokens + {step} - 1) // {step}) * {step} as bound from rows)",
        """shape as (select bound, row_number() over (order by bound) as j, sum(count(*)) over (order by bound) as many,
          sum(sum(n_tokens)) over (order by bound) as inside from rounded group by bound
          union all select -1, 0, 0, 0)""",
        "best0 as (select 0::bigint as j, 0::hugeint as best)",
    ]
    for k in range(1, BUCKETS + 1):
        # The least cost and, among equals, the least split.
        parts += [
            f"""step{k} as (select c.j, min((p.best + c.bound * (c.many - q.many) - (c.inside - q.inside))::hugeint * 1000000 + q.j)
              as choice from shape c join shape q on q.j < c.j join best{k - 1} p on p.j = q.j group by c.j)""",
            f"best{k} as (select j, choice // 1000000 as best from step{k} union all select 0, 0)",
        ]
    parts.append("cut8 as (select max(j) as j from shape)")
    for k in range(BUCKETS, 0, -1):
        parts.append(
            f"cut{k - 1} as (select coalesce((select choice % 1000000 from step{k} where j = (select j from cut{k})), 0) as j)"
        )
    found = " union ".join(f"select j from cut{k}" for k in range(1, BUCKETS + 1))
    parts += [
        f"""buckets as (select bound as bucket_tokens, row_number() over (order by bound) as bucket,
          coalesce(lag(bound) over (order by bound), -1) as low, greatest(1, {BATCH_TOKENS} // greatest(1, bound)) as size
          from shape where j > 0 and j in ({found}))""",
        """numbered as (select r.doc_id, r.n_tokens, b.bucket, b.bucket_tokens, b.size, row_number() over (
          partition by b.bucket order by md5('1:' || r.doc_id::varchar), r.n_tokens) - 1 as place
          from rounded r join buckets b on r.bound > b.low and r.bound <= b.bucket_tokens)""",
    ]
    return f"""with {', '.join(parts)}
      select doc_id, n_tokens, bucket::bigint as bucket, bucket_tokens::bigint as bucket_tokens,
        (place // size)::bigint as batch, (place % size)::bigint as slot from numbered"""


@query(_packing_sql())
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document."""
    return pack(documents(spark, sf_dir), buckets=BUCKETS, budget=BATCH_TOKENS)


CONTROL_TEXT = "\\### Assistant: </turn> ok"


@query()
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one full of control strings, formatted and read back."""
    given = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], given.schema
    )
    return read_back(chat_windows(given.unionByName(own)))


@query()
def op11_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents by two-word shingles, at a Jaccard similarity of 80 percent."""
    return odd_sketch_components(documents(spark, sf_dir), words=2, percent=80)


def planted_period(key: int | None, words: list[str]) -> list[str]:
    """The words of a document, of which a tenth by id repeat a part of their end over and over; never without an id."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (n // p + 1))[: n - a]


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, the strongest of them, and digests of all and of what is left."""
    found = periodic_runs(documents(spark, sf_dir), change=planted_period)
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    # Ratios are compared as products of whole numbers.
    best = F.expr(
        "aggregate(runs, runs[0], (x, r) -> if(x.length * r.period < r.length * x.period, r, x))"
    )
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated or given to the user, each a twentieth by id and turn."""
    blank = F.lit(" ")
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    kind, role, text = F.crc32(place) % 20, F.coalesce("role", blank), F.coalesce("text", blank)
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.expr("sequence(1, 2)")).alias("copy"), kind.alias("kind"),
    )
    return rows.where("kind <> 0 and (copy = 1 or kind = 3)").select("conv_id", "turn", "role", "text")


@query()
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with each damaged conversation, and the cheapest edits that repair it."""
    given = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair_report(damaged(given)).withColumnRenamed("conv_id", "found_id")
    ids = given.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # Of some conversations every row was dropped.
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )

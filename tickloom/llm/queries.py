"""One query per operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    bm25,
    byte_bpe,
    exact_dedup,
    html_text,
    language_id,
    license_scan,
    lm_score,
    mixing,
    prefix_trie,
    resampling,
    sharding,
    simhash,
    token_files,
)
from tickloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


@query(
    "op1_bm25",
    r"""
    with words as (
        select doc_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+'
        )) as word
        from documents
    ), held as (
        select doc_id, word, count(*) as times from words group by doc_id, word
    ), lengths as (
        select doc_id, sum(times) as length from held group by doc_id
    ), found as (
        select word, count(*) as docs from held group by word
    ), corpus as (
        select (select count(*) from documents) as docs,
            (select sum(times) from held) / cast((select count(*) from documents) as double) as length
    ), scored as (
        select q.doc_id as query_id, d.doc_id,
            round(sum(
                ln(1 + (c.docs - f.docs + 0.5) / (f.docs + 0.5))
                * d.times * 2.2 / (d.times + 1.2 * (0.25 + 0.75 * l.length / c.length))
            ), 6) as score
        from held q
        join held d on q.word = d.word
        join found f on f.word = d.word
        join lengths l on l.doc_id = d.doc_id
        cross join corpus c
        where q.doc_id % 100 = 0
        group by q.doc_id, d.doc_id
    ), ranked as (
        select *, row_number() over (partition by query_id order by score desc, doc_id) as place from scored
    )
    select query_id, cast(place as integer) as rank, doc_id, score from ranked where place <= 10
    """,
)
def op1_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    asked = bm25.query_words(documents.where(F.col("doc_id") % 100 == 0))
    return bm25.search(asked, bm25.build_index(documents))


@query("op2_html_text")
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return token_files.token_file_round_trip(table(spark, sf_dir, "documents"), vocabulary)


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


@query(
    "op6_mixing",
    r"""
    with sized as (
        select doc_id, source,
            cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
            md5(coalesce(text, '')) as digest
        from documents
    ), totals as (
        select source, cast(sum(size) as bigint) as source_size from sized group by source
    ), weighed as (
        select source, source_size, source_size * 3 as bound,
            (row_number() over (order by source collate "C" nulls last) - 1) % 3 + 1 as weight
        from totals
    ), levels as (
        select source, source_size, bound, weight,
            cast(sum(source_size) over () - coalesce(sum(bound) over before, 0) as double)
                / cast(sum(weight) over () - coalesce(sum(weight) over before, 0) as double) as level
        from weighed
        window before as (
            order by cast(bound as double) / weight, source collate "C" nulls last
            rows between unbounded preceding and 1 preceding
        )
    ), targets as (
        select source, source_size, least(cast(bound as double), max(level) over () * weight) as target
        from levels
    ), rated as (
        select s.doc_id, s.size, t.source_size, t.target,
            case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
            cast(('0x' || substr(md5('mix-1:' || coalesce(cast(s.doc_id as varchar), '') || ':' || s.digest), 1, 13)) as bigint)
                / 4503599627370496.0 as coin
        from sized s join targets t on s.source is not distinct from t.source
    )
    select doc_id, size, source_size, target,
        cast(size * (floor(rate) + case when coin < rate - floor(rate) then 1 else 0 end) as bigint) as taken
    from rated
    """,
)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted, names = mixing.with_copies(table(spark, sf_dir, "documents"))
    return counted.select(
        "doc_id",
        F.col(names["size"]).alias("size"),
        F.col(names["source_size"]).alias("source_size"),
        F.col(names["target"]).alias("target"),
        (F.col(names["size"]) * F.col(names["copies"])).alias("taken"),
    )


@query("op7_lm_score")
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(table(spark, sf_dir, "documents"))


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    documents = table(spark, sf_dir, "documents")
    return byte_bpe.digests(byte_bpe.encode_decode(documents, vocabulary, public_tokenizers.PATTERN))


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    named, lang_pred, score = language_id.identify(documents, language_id.fit(documents))
    return named.select(
        "doc_id",
        language_id.held_out().alias("held_out"),
        F.col(lang_pred).alias("lang_pred"),
        F.col(score).alias("score"),
    )


@query(
    "op10_exact_dedup",
    r"""
    with bare as (
        select doc_id, length(coalesce(text, '')) as n_chars,
            regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as bare
        from documents
    ), placed as (
        select *, row_number() over (partition by bare order by n_chars desc, doc_id nulls last) as place,
            first_value(doc_id) over (partition by bare order by n_chars desc, doc_id nulls last) as keep_id,
            cast(count(*) over (partition by bare) as bigint) as group_size
        from bare
    )
    select doc_id, keep_id, group_size, place = 1 as kept, sha256(bare) as text_sha256 from placed
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("n_chars")


#: DuckDB has no crc32: its table by the rule of the polynomial, and a fold over bytes.
_CRC_TABLE = """[list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)
            for n in range(256)]"""


def _crc32(bytes_: str) -> str:
    """SQL of the unsigned crc32 of a list of byte values, with the table in `crc_table.entries`."""
    fold = "lambda c, b: xor(entries[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce({bytes_}, {fold}, 4294967295), 4294967295)"


def _bytes(text: str) -> str:
    """SQL of the values of a text's bytes in UTF-8."""
    return f"[('0x' || pair)::bigint for pair in regexp_extract_all(hex(encode({text})), '..')]"


@query(
    "op11_prefix_trie",
    rf"""
    with crc_table as (
        select {_CRC_TABLE} as entries
    ), cleaned as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        where conv_id is not null
    ), hashed as (
        select *, sha256(concat(length(role), ':', role, ':', text)) as digest,
            len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
        from cleaned
    ), turns as (
        select *, row_number() over (partition by conv_id order by turn nulls first, digest) - 1 as pos from hashed
    ), convs as (
        select conv_id, conv_id - conv_id % 20 as base, {_crc32(_bytes("cast(conv_id as varchar)"))} % 4 as h
        from (select distinct conv_id from turns), crc_table
    ), taken as (
        select c.conv_id, t.pos, t.digest, t.words from convs c join turns t on t.conv_id = c.base and t.pos < c.h
    ), known as (
        select c.conv_id, c.h, count(t.pos) as taken from convs c left join taken t using (conv_id) group by all
    ), rebuilt as (
        select * from taken
        union all
        select t.conv_id, t.pos - k.h + k.taken, t.digest, t.words
        from turns t join known k using (conv_id) where t.pos >= k.h
    ), prefixes as (
        select conv_id, pos + 1 as depth, words,
            string_agg(digest, ',') over (partition by conv_id order by pos) as way from rebuilt
        union all select conv_id, 0, 0, '' from convs
    ), nodes as (
        select depth, way, min(conv_id) as conv_id, count(*) as n_convs, min(words) as words
        from prefixes group by depth, way
    ), ways as (
        select p.conv_id as member, p.depth, n.conv_id,
            p.depth = max(p.depth) over (partition by p.conv_id) as ends
        from prefixes p join nodes n using (depth, way)
    ), linked as (
        select n.conv_id, n.depth, n.n_convs, (n.n_convs - 1) * n.words as saved, up.conv_id as parent_conv_id
        from nodes n left join ways up on up.member = n.conv_id and up.depth = n.depth - 1
    ), children as (
        select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n_children
        from linked where depth > 0 group by all
    ), counted as (
        select l.*, coalesce(n_children, 0) as n_children from linked l left join children using (conv_id, depth)
    ), totals as (
        select w.conv_id, w.depth, sum(cast(c.n_children = 0 as bigint)) as n_leaves, sum(c.saved) as saved_tokens
        from counted c join ways w on w.member = c.conv_id and w.depth <= c.depth group by all
    ), ended as (
        select conv_id, depth, sha256(string_agg(cast(member as varchar), ',' order by member)) as ends_sha256
        from ways where ends group by all
    )
    select conv_id, cast(depth as bigint) as depth, parent_conv_id, n_convs, n_children,
        cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens,
        coalesce(ends_sha256, sha256('')) as ends_sha256
    from counted join totals using (conv_id, depth) left join ended using (conv_id, depth)
    """,
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query(
    "op12_resampling",
    rf"""
    with crc_table as (
        select {_CRC_TABLE} as entries
    ), texts as (
        select false as aimed, row_number() over () as row, doc_id, text from documents
        union all select true, row_number() over (), null, text from benchmark
    ), split as (
        select aimed, row, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'
        ) as words
        from texts
    ), features as (
        select aimed, row, unnest(words) as word from split
    ), bucketed as (
        select word, {_crc32(_bytes("word"))} % 10000 as bucket
        from (select distinct word from features), crc_table
    ), held as (
        select bucket, count(*) filter (where not aimed) as s, count(*) filter (where aimed) as t
        from features join bucketed using (word) group by bucket
    ), gained as (
        select bucket, cast(floor(1000 * ln(
            (t + 1) * cast(sum(s) over () + 10000 as double) / ((s + 1) * cast(sum(t) over () + 10000 as double))
        )) as bigint) as gain
        from held
    ), weighed as (
        select row, cast(sum(gain) as bigint) as weight
        from features join bucketed using (word) join gained using (bucket) where not aimed group by row
    ), scored as (
        select row, doc_id, cast(len(words) as bigint) as n_features, coalesce(weight, 0) as weight,
            coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
                (cast('0x' || substr(sha256('2024:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) + 0.5::double)
                / 4294967296
            ))) as bigint) as score
        from split left join weighed using (row) where not aimed
    ), placed as (
        select row, row_number() over (order by score desc, doc_id nulls last, row) as place, count(*) over () as able
        from scored where n_features >= 20
    )
    select doc_id, n_features, weight, score, case when place <= able * 10 // 100 then place end as rank
    from scored left join placed using (row)
    """,
)
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.importance(documents, benchmark).drop("row", "n_words")


def _accepts(regions: tuple) -> str:
    """A regular expression over ' '-led words for the regions of a license template."""
    out = ""
    for region in regions:
        if isinstance(region, license_scan.Word):
            out += " " + region.text.decode()
        elif isinstance(region, license_scan.Any):
            out += f"(?: [^ ]+){{{region.least},{region.most}}}"
        else:
            out += "(?:" + "|".join(map(_accepts, region.ways)) + ")"
    return out


def _license_sql() -> str:
    """Templates as regular expressions, phrases by the words that follow each other."""
    said = []
    for number, template in enumerate(license_scan.all_templates()):
        regions = license_scan.parse(template.markup)
        regex = _accepts(regions).replace("'", "''")
        said.append(
            f"case when regexp_matches(line, '{regex}( |$)') then "
            f"{{'label': '{template.label}', 'mandatory': {license_scan.mandatory_words(regions)}}} end"
        )
    return f"""
    with split as (
        select row_number() over () as row, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'
        ) as words
        from documents
    ), placed as (
        select row, unnest(words) as word, generate_subscripts(words, 1) - 1 as spot from split
    ), followed as (
        select row, spot, word, lead(word) over near as word2, lead(word, 2) over near as word3
        from placed window near as (partition by row order by spot)
    ), phrased as (
        select row, cast(spot as bigint) as spot, case
            when word = 'mit' and word2 = 'license' then 'mit'
            when word = 'apache' and word2 = 'license' then 'apache'
            when word = 'general' and word2 = 'public' and word3 = 'license' then 'gpl' end as label
        from followed
    ), base as (
        select row, count(*) as n_base, min(spot) as first_word, max(spot) as last_word,
            array_to_string(list_sort(list(distinct label)), ',') as base_labels
        from phrased where label is not null group by row
    ), lines as (
        select *, ' ' || array_to_string(words, ' ') as line from split
    ), accepted as (
        select row, list_filter([{", ".join(said)}], lambda x: x is not null) as held from lines
    )
    select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
        coalesce(base_labels, '') as base_labels,
        array_to_string(list_sort(list_distinct([x.label for x in held])), ',') as labels,
        coalesce(list_max([x.mandatory for x in held]), 0)
            / (coalesce(list_max([x.mandatory for x in held]), 0) + {license_scan.HALF}::double) as score
    from split join accepted using (row) left join base using (row)
    """


@query("op13_license_scan", _license_sql())
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(table(spark, sf_dir, "documents"))

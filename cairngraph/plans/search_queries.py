"""Queries of the filter, text and vector operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairngraph.operators import search, vectors
from cairngraph.plans.registry import query
from cairngraph.session import cut


@query(
    "fl01_find_nodes",
    """select id, content from neurons where type = 'STANDARD' and contains(lower(content), 'ring')""",
    "neurons",
)
def find_nodes(t):
    found = search.find_nodes(t.neurons, type="STANDARD", contains="RING")
    return found.select("id", "content")


@query(
    "fl01_find_nodes_paged",
    """select id, content, 0 as page from (select * from neurons where type = 'STANDARD' order by id limit 100)
        union all
        select id, content, 1 from (select * from neurons where type = 'STANDARD' and id > 'p:1500' order by id limit 50)
        union all
        select id, content, 2 from (select * from neurons where type = 'STANDARD' order by id limit 20 offset 10)""",
    "neurons",
)
def find_nodes_paged(t):
    pages = [
        search.find_nodes(t.neurons, type="STANDARD", limit=100),
        search.find_nodes(t.neurons, type="STANDARD", limit=50, after="p:1500"),
        search.find_nodes(t.neurons, type="STANDARD", limit=20, offset=10),
    ]
    numbered = [page.select("id", "content", F.lit(n).alias("page")) for n, page in enumerate(pages)]
    return numbered[0].unionByName(numbered[1]).unionByName(numbered[2])


@query(
    "fl02_find_edges",
    """select src, dst, edge_type, weight from edges where edge_type = 'CALLS' and weight >= 0.5""",
    "edges",
)
def find_edges(t):
    found = search.find_edges(t.edges, type="CALLS", min_weight=0.5)
    return found.select("src", "dst", "edge_type", "weight")


ACTIVE = "generation_id in (select generation_id from generations where status = 'active')"


@query(
    "fl03_active_symbols",
    f"select id, generation_id from nodes where {ACTIVE}",
    "nodes generations",
)
def active_symbols(t):
    return search.active_symbols(t.nodes, t.generations).select("id", "generation_id")


@query(
    "fl03_active_symbols_of_projects",
    f"""select id, project_path from nodes where project_path = '/proj/1' and {ACTIVE}""",
    "nodes generations",
)
def active_symbols_of_projects(t):
    # /proj/4 has generations but no active one, so it adds nothing.
    parts = [
        search.active_symbols(t.nodes, t.generations, project)
        for project in ("/proj/1", "/proj/x/../4")
    ]
    return parts[0].unionByName(parts[1]).select("id", "project_path")


@query(
    "fl04_code_edges",
    "select src, dst, line from edges where edge_type = 'IMPORTS'",
    "edges",
)
def code_edges(t):
    tagged = t.edges.withColumns(
        {"type": F.lit("RELATED_TO"), "tags": F.array(F.lit(search.CODE_TAG))}
    )
    return search.code_edges(tagged, "IMPORTS").select("src", "dst", "line")


@query(
    "fl05_visible",
    """select 'brains' as table_name, id as brain_id, cast(1 as bigint) as rows from brains
        where owner_id = 'u:2' or is_public
        union all
        select 'fibers', brain_id, count(*) from fibers
        where brain_id in (select id from brains where owner_id = 'u:2') group by brain_id
        union all
        select 'fiber_neurons', brain_id, count(*) from fiber_neurons
        where brain_id in (select id from brains where owner_id = 'u:2') group by brain_id""",
    "brains fibers fiber_neurons",
)
def visible(t):
    tables = {"brains": t.brains, "fibers": t.fibers, "fiber_neurons": t.fiber_neurons}
    seen = search.visible(tables, "u:2")
    seen["brains"] = seen["brains"].withColumnRenamed("id", "brain_id")
    counted = [
        seen[name]
        .groupBy("brain_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table_name"), "brain_id", "rows")
        for name in tables
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query(
    "fl05_visible_rows",
    """select 'brains' as table_name, id as a, owner_id as b from brains where owner_id = 'u:2' or is_public
        union all
        select 'fibers', id, brain_id from fibers where brain_id in (select id from brains where owner_id = 'u:2')
        union all
        select 'fiber_neurons', fiber_id, neuron_id from fiber_neurons
        where brain_id in (select id from brains where owner_id = 'u:2')""",
    "brains fibers fiber_neurons",
)
def visible_rows(t):
    seen = search.visible({"brains": t.brains, "fibers": t.fibers, "fiber_neurons": t.fiber_neurons}, "u:2")
    parts = [
        seen[name].select(F.lit(name).alias("table_name"), F.col(a).alias("a"), F.col(b).alias("b"))
        for name, a, b in (("brains", "id", "owner_id"), ("fibers", "id", "brain_id"), ("fiber_neurons", "fiber_id", "neuron_id"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "fl06_symbol_search",
    f"""select id, qualified_name, file, line from nodes where {ACTIVE}
          and contains(lower(content), 'widget') and (contains(lower(name), 'widget')
            or contains(lower(qualified_name), 'widget') or contains(kind, 'widget')
            or contains(language, 'widget'))
        order by qualified_name, file, line, id limit 20""",
    "nodes generations",
)
def symbol_search(t):
    found = search.search(t.nodes, t.generations, "Widget")
    return found.select("id", "qualified_name", "file", "line")


@query(
    "fl07_suggest",
    """select id, content, access_frequency from neurons where starts_with(content, 're')
        order by access_frequency desc, content, id limit 5""",
    "neurons",
)
def suggest(t):
    return search.suggest(t.neurons, "re").select("id", "content", "access_frequency")


STOPS = ", ".join(f"'{w}'" for w in search.STOP_WORDS)
WORDS = f"""
    words as (
      select distinct doc_id, token from (
        select doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) as token
        from documents) x
      where token <> '' and token not in ({STOPS}))"""


@query(
    "fl08_text_match",
    f"""with {WORDS.strip()}
        select doc_id from words where token in ('les', 'des') group by doc_id
        having count(*) = 2""",
)
def text_match(t):
    blocks = cut(search.posting_blocks(t.documents, "doc_id", "text"))
    return search.match_blocks(blocks, "Les, DES the").select(F.col("id").alias("doc_id"))


@query(
    "fl08_text_scan",
    f"""with {WORDS.strip()}
        select doc_id from words where token in ('les', 'des') group by doc_id
        having count(*) = 2""",
)
def text_scan(t):
    return search.text_match(t.documents, "Les, DES the", "text").select("doc_id")


@query(
    "fl09_inverted_index",
    f"""with {WORDS.strip()}
        select token, count(*) as df, min(doc_id) as first_id, max(doc_id) as last_id
        from words group by token""",
)
def inverted_index(t):
    return search.token_frequencies(search.posting_blocks(t.documents, "doc_id", "text"))


@query(
    "fl09_posting_blocks",
    f"""with {WORDS.strip()} select token, cast(floor(doc_id / 64) as bigint) as block_no,
          string_agg(cast(doc_id as varchar), ',' order by doc_id) as ids, min(doc_id) as first_id,
          max(doc_id) as last_id, cast(count(*) as integer) as n
        from words group by token, cast(floor(doc_id / 64) as bigint)""",
)
def posting_blocks(t):
    # ranges of 64 documents, so that frequent words have many blocks; lists are compared id by id
    blocks = search.posting_blocks(t.documents, "doc_id", "text", span=64)
    start = F.struct(F.col("first_id").alias("at"), F.lit("").alias("ids"))

    def step(state, delta):
        at = state["at"] + delta
        return F.struct(at.alias("at"), F.concat(state["ids"], F.lit(","), at.cast("string")).alias("ids"))

    ids = F.aggregate("deltas", start, step, lambda state: F.substr(state["ids"], F.lit(2)))
    return blocks.select("token", "block_no", ids.alias("ids"), "first_id", "last_id", "n")


def label_means(t, key: str):
    """The mean vector of each label, as queries or as list centroids."""
    values = t.embeddings.select("label", F.posexplode("embedding").alias("pos", "v"))
    means = values.groupBy("label", "pos").agg(F.avg(F.col("v").cast("double")).alias("v"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "v")))
    vector = F.transform(ordered, lambda e: e["v"])
    return means.groupBy("label").agg(vector.alias("embedding")).select(
        F.col("label").cast("bigint").alias(key), "embedding"
    )


MEANS = """
    means as (
      select cast(label as bigint) as id, list(v order by pos) as q from (
        select label, pos, avg(cast(v as double)) as v from (
          select label, unnest(embedding) as v, generate_subscripts(embedding, 1) as pos
          from embeddings) x group by label, pos) y group by label)"""


@query(
    "fl10_vector_top_k",
    f"""with {MEANS.strip()}
        select query_id, id, round(s, 6) as similarity, cast(rank as integer) as rank from (
          select means.id as query_id, vec_id as id,
            list_cosine_similarity(cast(embedding as double[]), q) as s,
            row_number() over (partition by means.id order by
              list_cosine_similarity(cast(embedding as double[]), q) desc, vec_id) as rank
          from embeddings, means) z
        where rank <= 10""",
)
def vector_top_k(t):
    stored = t.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    hits = vectors.knn(stored, label_means(t, "id"), 10)
    return hits.withColumn("similarity", F.round("similarity", 6))


@query(
    "fl11_bucketed_top_k",
    f"""with {MEANS.strip()},
        near as (
          select vec_id, cast(embedding as double[]) as v, arg_max(means.id,
              list_cosine_similarity(cast(embedding as double[]), q)) as list_id
          from embeddings, means group by vec_id, embedding),
        probe as (
          select a.id as query_id, b.id as list_id, row_number() over (partition by a.id
            order by list_cosine_similarity(a.q, b.q) desc, b.id) as r
          from means a, means b)
        select query_id, id, round(s, 6) as similarity, cast(rank as integer) as rank from (
          select query_id, vec_id as id, list_cosine_similarity(v, q) as s,
            row_number() over (partition by query_id
              order by list_cosine_similarity(v, q) desc, vec_id) as rank
          from probe join near using (list_id) join means on query_id = means.id where r <= 3) z
        where rank <= 10""",
)
def bucketed_top_k(t):
    stored = t.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    hits = vectors.knn_lists(stored, label_means(t, "id"), 10, label_means(t, "list_id"), probes=3)
    return hits.withColumn("similarity", F.round("similarity", 6))


@query(
    "fl12_live_memories",
    """select fiber_id, memory_type, round(trust_score, 6) as trust_score from memories
        where (expires_at is null or expires_at > timestamp '2024-01-20 12:00:00')
          and memory_type = 'click' and project_id = 'pr:1' and trust_score >= 0.25""",
    "memories",
)
def live_memories(t):
    at = F.lit("2024-01-20 12:00:00").cast("timestamp")
    live = search.live_memories(t.memories, at, "click", "pr:1", 0.25)
    return live.select("fiber_id", "memory_type", F.round("trust_score", 6).alias("trust_score"))

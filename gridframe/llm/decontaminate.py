"""Benchmark items inside documents: size-partitioned MinHash containment search, then exact verification.

An item is contained in a document if at least `threshold` of the item's distinct
word shingles occur in it. Documents may be thousands of times longer than items,
so their Jaccard similarity says nothing; the search is for containment. Items are
partitioned by the power of two below their number of shingles, and each partition
has its own signature length: with at most `u` shingles in an item of the partition,
the u - ceil(threshold * u) + 1 smallest hash values of an item are its MinHash
signature. A document that contains the item lacks at most u - ceil(threshold * u)
of its shingles, so it has at least one shingle of the signature: no match is lost.

The documents' shingle hashes are joined with the signatures (broadcast if there are
at most `common.MAX_BROADCAST` of them, shuffled otherwise). Candidate pairs are written,
then the candidates' texts alone are read again, and shingles are compared as text.

Words are runs of letters and digits in lower case. Items and documents of fewer
than five words have no shingle and match nothing; so do null texts. Rows that
repeat an id count as one document (its best row) or one item. Rows with a null id
are not reported. Other columns are ignored by `contained`. `without` keeps them, and
decides by row: of rows with one id those go whose own text contains an item, and a
row without an id goes as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.llm.common import digest, keyed, words
from gridframe.llm.common import small as _small
from gridframe.shared import written

SHINGLE = 5


def _grams(w: Column, make) -> Column:
    """`make` of every five successive words."""
    places = F.sequence(F.lit(0), F.size(w) - SHINGLE)
    return F.when(F.size(w) >= SHINGLE, F.transform(places, lambda i: make(*(F.get(w, i + k) for k in range(SHINGLE)))))


def shingle_hashes(w: Column) -> Column:
    return F.array_distinct(_grams(w, F.xxhash64))


def shingle_texts(w: Column) -> Column:
    return F.array_distinct(_grams(w, lambda *x: F.concat_ws(" ", *x)))


def signatures(items: DataFrame, threshold: float) -> DataFrame:
    """Rows (item_id, h): each item's smallest shingle hashes, as many as its size partition asks for."""
    hashed = items.withColumn("h", shingle_hashes(F.col("w"))).where(F.size("h") > 0)
    top = F.pow(F.lit(2), F.floor(F.log2(F.size("h"))) + 1).cast("long") - 1
    length = (top - F.ceil(top * threshold - 1e-9) + 1).cast("int")
    return hashed.select("item_id", F.explode(F.slice(F.array_sort("h"), F.lit(1), length)).alias("h")).distinct()


def contained(docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per match: doc_id, item_id, n_shingles (of the item), n_found, containment."""
    docs = keyed(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    items = items.select(items[item_col].alias("item_id"), words(items[item_text]).alias("w")).where(F.col("item_id").isNotNull())
    sought = written(signatures(items, threshold), "signatures")
    hashed = docs.select("doc_id", words(F.col("text")).alias("w")).select("doc_id", F.explode(shingle_hashes(F.col("w"))).alias("h"))
    pairs = written(hashed.join(_small(sought), "h").select("doc_id", "item_id").distinct(), "candidates")
    candidates = written(pairs.select("doc_id").distinct(), "candidate-ids")
    texts = docs.join(_small(candidates), "doc_id", "left_semi")
    texts = texts.select("doc_id", words(F.col("text")).alias("w")).select("doc_id", shingle_texts(F.col("w")).alias("has"))
    wanted = items.select("item_id", shingle_texts(F.col("w")).alias("wants"))
    found = pairs.join(texts, "doc_id").join(_small(wanted, 20_000), "item_id")
    found = found.select("doc_id", "item_id", F.size("wants").cast("long").alias("n_shingles"), F.size(F.array_intersect("wants", "has")).cast("long").alias("n_found"))
    found = found.withColumn("containment", F.col("n_found") / F.col("n_shingles")).where(F.col("containment") >= threshold)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_found", "n_shingles")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_shingles", "best.n_found", "best.containment")


def without(docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows whose text contains an item; all columns kept."""
    row = digest(F.concat_ws("\n", F.coalesce(docs[id_col].cast("string"), F.lit("")), docs[text_col]))
    hits = contained(docs.select(row.alias("doc_id"), docs[text_col].alias("text")), items, threshold)
    hits = written(hits.select(F.col("doc_id").alias("__hit")).distinct(), "hits")
    return docs.join(_small(hits), row == hits["__hit"], "left_anti")


#: The same by SQL: exact containment of every item in every document.
ORACLE = """
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents
), iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM dw)
), iss AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM iw)
), n AS (
  SELECT item_id, count(*) AS n_shingles FROM iss GROUP BY item_id
)
SELECT doc_id, item_id, n_shingles, count(*) AS n_found, count(*) / n_shingles AS containment
FROM ds JOIN iss USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) / n_shingles >= 0.8
"""

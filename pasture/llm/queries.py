"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pasture.sources.tables import table

QUERIES = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op2_simhash_dedup(spark, sf_dir):
    """Fingerprint and class of every document: three-word shingles, radius 2."""
    from pasture.llm.simhash_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2, seed=42)


@_query
def op5_substring_dedup(spark, sf_dir):
    """Every document without the words of 35-word windows that repeat anywhere."""
    from pasture.llm.substring_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"), length=35).drop("kept")


@_query
def op6_token_counts(spark, sf_dir):
    """Token counts of every whole document."""
    import public_tokenizers
    from pasture.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@_query
def op8_bpe_round_trip(spark, sf_dir):
    """Ids and decoded text of every whole document, as digests."""
    import public_tokenizers
    from pasture.llm.bpe_transducer import round_trip
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op10_warc_round_trip(spark, sf_dir):
    """Every page written to WARC archives and read back."""
    from pasture.llm.warc_chunks import round_trip
    return round_trip(table(spark, sf_dir, "pages"))


@_query
def op3_quality_ledger(spark, sf_dir):
    """Measurements, failure bits and the current policy's verdict of every document, from the stored ledger."""
    from pasture.llm.quality_ledger import ledger, verdicts
    from pasture.llm.scratch import stored
    return verdicts(stored(ledger(table(spark, sf_dir, "documents")), "ledger"))


@_query
def op4_url_equivalence(spark, sf_dir):
    """Host, path, rule and verdict of every page's url."""
    from pasture.llm.url_equivalence import decisions
    return decisions(table(spark, sf_dir, "pages"))


def _load_sql():
    from pasture.llm import (line_dedup, merkle_manifest, prefix_trie, quality_ledger, substring_dedup, url_equivalence,
                             warc_chunks)
    ORACLE["op3_quality_ledger"] = quality_ledger.ORACLE_SQL
    ORACLE["op4_url_equivalence"] = url_equivalence.oracle_sql()
    ORACLE["op5_substring_dedup"] = substring_dedup.oracle_sql()
    ORACLE["op10_warc_round_trip"] = warc_chunks.ORACLE_SQL
    ORACLE["op11_prefix_trie"] = prefix_trie.oracle_sql(every=20)
    ORACLE["op12_merkle_manifest"] = merkle_manifest.oracle_sql(every=7)
    ORACLE["op13_line_dedup"] = line_dedup.oracle_sql(min_docs=10)


_load_sql()


@_query
def op7_decontaminate(spark, sf_dir):
    """Every document and benchmark item it holds, at a shingle similarity of 0.8 or more."""
    from pasture.llm.decontaminate import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op9_pii_spans(spark, sf_dir):
    """Base and added spans of personal data in every document."""
    from pasture.llm.pii_spans import find
    return find(table(spark, sf_dir, "documents"))


@_query
def op1_toxicity_kn(spark, sf_dir):
    """Toxicity score of every document; labels of held-out documents are never read."""
    from pasture.llm.toxicity_kn import fit, score
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))


@_query
def op13_line_dedup(spark, sf_dir):
    """Every document without the lines whose key ten documents or more have."""
    from pasture.llm.line_dedup import digests
    return digests(table(spark, sf_dir, "documents"), min_docs=10)


@_query
def op12_merkle_manifest(spark, sf_dir):
    """Leaf, roots, proof digest and verification of every document, after tampering with some."""
    from pasture.llm.merkle_manifest import verified
    return verified(table(spark, sf_dir, "documents"), every=7)


@_query
def op11_prefix_trie(spark, sf_dir):
    """Every prefix of the rebuilt conversations, with its members, children and subtree totals."""
    from pasture.llm.prefix_trie import trie
    return trie(table(spark, sf_dir, "conversations"), every=20)

"""Brute-force forms shared by the pipeline test."""
from test_decontaminate import brute as brute_items  # noqa: F401
from test_quality_ledger import measure
from test_simhash_dedup import brute as brute_simhash


def brute_measures(text):
    n, chars, symbols, lines, dup, rep = measure(text)
    return not (n < 50 or 100 * rep > 50 * n or 100 * symbols > 4 * chars or 100 * dup > 40 * lines or chars > 15 * n or chars < 2 * n)


def brute_classes(texts):
    return {d: c for d, _, c in brute_simhash(list(texts.items()))}

"""The queries of the training-data operators and their SQL."""

from . import alignment, chains, circulant, html_text, langid, lexical, mixing, ngram_join, packing, quality, topk, toxicity, warc

MODULES = (warc, quality, langid, toxicity, html_text, topk, ngram_join, packing, mixing, chains, alignment, lexical, circulant)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in MODULES for k, v in m.ORACLES.items()}

"""Operators over the verse relation: vocabulary, windows, quality, correction, alignment, concordance, lexicon."""

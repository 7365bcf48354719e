"""Operators for preparing training text: licence scan, quality and toxicity
scores, decontamination, fingerprints, substring / line / document dedup,
subword encoding and revisit resolution.  Nothing outside imports this
subpackage."""

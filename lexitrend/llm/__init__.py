"""Training-data operators: near and exact dedup, toxicity, licences, quality, decontamination,
packing, token files, personal data and HTML extraction. Nothing else in the library imports
this subpackage."""

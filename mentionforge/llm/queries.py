"""The corpus operators' queries and, where SQL can express them, their SQL."""

from __future__ import annotations

import corpus_pipeline
from mentionforge.llm import decontamination, filter_audit, fingerprints, language_mixture, license_scan, merkle_manifest, pitman_yor_lm, pu_quality, quality_rules, simhash_tiles, slack_packing, source_mixing, warc_archive

QUERIES = {
    "op1_fingerprints": fingerprints.query,
    "op2_warc_archive": warc_archive.query,
    "op3_simhash_neardup": simhash_tiles.query,
    "op4_license_scan": license_scan.query,
    "op5_quality_rules": quality_rules.query,
    "op6_slack_packing": slack_packing.query,
    "op7_language_mixture": language_mixture.query,
    "op8_pu_quality": pu_quality.query,
    "op9_pitman_yor_lm": pitman_yor_lm.query,
    "op10_source_mixing": source_mixing.query,
    "op11_decontamination": decontamination.query,
    "op12_filter_audit": filter_audit.query,
    "op13_merkle_manifest": merkle_manifest.query,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op2_warc_archive": warc_archive.ORACLE,
    "op5_quality_rules": quality_rules.ORACLE,
    "op10_source_mixing": source_mixing.ORACLE,
    "op11_decontamination": decontamination.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
    "op13_merkle_manifest": merkle_manifest.ORACLE,
}

"""The operators as registered queries over the driver's tables."""

from __future__ import annotations

from treeclass.llm import collocations, curve_packing, decontaminate, embedding_tiles, fertility, line_runs, lpf_dedup, pseudo_likelihood, simhash_pivots, token_edits, tokens, toxicity, warc, whitening
from treeclass.llm.common import table


def op1_factorization_machine(spark, sf_dir):
    return toxicity.op1(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_edits(spark, sf_dir):
    return token_edits.op2(table(spark, sf_dir, "documents"), tokens.file(tokens.RANKS))


def op3_pseudo_likelihood(spark, sf_dir):
    return pseudo_likelihood.op3(table(spark, sf_dir, "documents"))


def op4_warc(spark, sf_dir):
    return warc.op4(table(spark, sf_dir, "pages"))


def op5_positional_index(spark, sf_dir):
    return decontaminate.op5(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_fertility(spark, sf_dir):
    return fertility.op6(table(spark, sf_dir, "documents"), tokens.file(tokens.RANKS), tokens.file(tokens.PIECES))


def op7_simhash_pivots(spark, sf_dir):
    return simhash_pivots.op7(table(spark, sf_dir, "documents"))


def op8_lpf_dedup(spark, sf_dir):
    return lpf_dedup.op8(table(spark, sf_dir, "documents"))


def op9_curve_packing(spark, sf_dir):
    return curve_packing.op9(table(spark, sf_dir, "documents"), tokens.file(tokens.RANKS))


def op10_line_runs(spark, sf_dir):
    return line_runs.op10(table(spark, sf_dir, "documents"))


def op11_setm_phrases(spark, sf_dir):
    return collocations.op11(table(spark, sf_dir, "documents"))


def op12_jacobi_davidson(spark, sf_dir):
    return whitening.op12(table(spark, sf_dir, "embeddings"))


def op13_int8_tiles(spark, sf_dir):
    return embedding_tiles.op13(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_factorization_machine, op2_token_edits, op3_pseudo_likelihood, op4_warc, op5_positional_index, op6_fertility, op7_simhash_pivots, op8_lpf_dedup, op9_curve_packing, op10_line_runs, op11_setm_phrases, op12_jacobi_davidson, op13_int8_tiles)}

ORACLE_SQL = {"op4_warc": warc.ORACLE_SQL, "op5_positional_index": decontaminate.ORACLE_SQL, "op10_line_runs": line_runs.ORACLE_SQL,
              "op11_setm_phrases": collocations.ORACLE_SQL, "op13_int8_tiles": embedding_tiles.ORACLE_SQL}

"""Queries of this subpackage, by name, and the SQL that checks them."""

from __future__ import annotations

from .bpe import op6_bpe
from .decontaminate import OP5_SQL, op5_decontaminate
from .language_model import op9_language_model
from .license import OP2_SQL, op2_license_scan
from .line_dedup import OP1_SQL, op1_line_dedup
from .near_dup import OP10_SQL, op10_minhash_near_dup
from .pii import op3_pii
from .quality import OP4_SQL, op4_quality_rules
from .token_file import op8_token_file
from .url_filter import OP7_SQL, op7_url_filter

QUERIES = {"op1_line_dedup": op1_line_dedup, "op2_license_scan": op2_license_scan, "op3_pii": op3_pii, "op4_quality_rules": op4_quality_rules, "op5_decontaminate": op5_decontaminate, "op6_bpe": op6_bpe, "op7_url_filter": op7_url_filter, "op8_token_file": op8_token_file, "op9_language_model": op9_language_model, "op10_minhash_near_dup": op10_minhash_near_dup}
ORACLE_SQL = {"op1_line_dedup": OP1_SQL, "op2_license_scan": OP2_SQL, "op4_quality_rules": OP4_SQL, "op5_decontaminate": OP5_SQL, "op7_url_filter": OP7_SQL, "op10_minhash_near_dup": OP10_SQL}

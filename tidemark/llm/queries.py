"""The queries of this package and, where SQL can say the same, their SQL for DuckDB."""

from tidemark.llm.decontaminate import OP9_SQL, op9_decontaminate
from tidemark.llm.huffman import op7_token_files
from tidemark.llm.lattice import op1_lattice
from tidemark.llm.line_dedup import OP6_SQL, op6_line_dedup
from tidemark.llm.packing import op2_packing
from tidemark.llm.pii import op5_pii
from tidemark.llm.prefix_forest import op3_prefix_forest
from tidemark.llm.simhash import op8_simhash
from tidemark.llm.suffix_index import op10_suffix_index
from tidemark.llm.toxicity import op4_toxicity

QUERIES = {
    "op1_lattice": op1_lattice,
    "op2_packing": op2_packing,
    "op3_prefix_forest": op3_prefix_forest,
    "op4_toxicity": op4_toxicity,
    "op5_pii": op5_pii,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_files": op7_token_files,
    "op8_simhash": op8_simhash,
    "op9_decontaminate": op9_decontaminate,
    "op10_suffix_index": op10_suffix_index,
}

ORACLES = {
    "op6_line_dedup": OP6_SQL,
    "op9_decontaminate": OP9_SQL,
}

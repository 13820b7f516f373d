import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import benchmark, benchmark_texts, document_rows, documents, no_documents  # noqa: E402, F401

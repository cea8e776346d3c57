import pytest

pytest.importorskip("loomline.llm")

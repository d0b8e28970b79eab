"""Column expressions. All of them stay inside whole-stage codegen."""

from plumbline.functions.numeric import safe_int
from plumbline.functions.text import ascii_fold, normalized

__all__ = ["ascii_fold", "normalized", "safe_int"]

"""Key normalisation."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: characters a warehouse TRIM removes --------------------------
# Spark's one-argument trim() strips only U+0020; these are the ASCII controls
# \t \n \v \f \r, the space, and the Unicode space separators (category Zs/Zl/Zp).
WHITESPACE = ("\t\n\u000b\f\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
              "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# ---------------------------------------------------------------------------------


def trim_ws(c) -> Column:
    """Strip leading/trailing whitespace of any kind (``btrim`` with a character
    set: a codegen'd scan of the ends, no regular expression per row). ``btrim`` looks every
    end up in the set, so values whose ends are visible ASCII, nearly all, are told by two comparisons an end."""
    c = F.col(c) if isinstance(c, str) else c
    last = c.substr(F.lit(-1), F.lit(1))
    odd = (c < "!") | (c >= "\x7f") | (last < "!") | (last >= "\x7f")
    return F.when(odd, F.btrim(c, F.lit(WHITESPACE))).otherwise(c)


def norm_key(c) -> Column:
    """Trimmed identifier."""
    return trim_ws(c)


def norm_code(c) -> Column:
    """Trimmed, lower-cased vocabulary value (status, event type, system)."""
    return F.lower(trim_ws(c))

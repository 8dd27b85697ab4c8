"""voxloom: a PySpark engine for curating multilingual speech and transcript data.

Every operator takes and returns DataFrames or Columns and stays lazy.  The
subpackage ``llm`` builds on the rest; nothing else imports it.
"""

__version__ = "0.1.0"

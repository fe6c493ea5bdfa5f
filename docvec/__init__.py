"""Document preparation and vector retrieval as Spark jobs.

Import the layers from their own modules:

* ``docvec.functions``: column expressions (text, chunks, vectors)
* ``docvec.operators``: DataFrame to DataFrame steps (diff, embed, search)
* ``docvec.sources``: tables and document sources
* ``docvec.plans``: the four incremental stages and their audit trail
"""

from docvec.options import Options

__all__ = ["Options"]

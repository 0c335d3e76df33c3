"""DataFrame -> DataFrame transforms; the windowed ones run on static tables and on streams."""

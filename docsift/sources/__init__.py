"""Sources: files (batch and incremental), tables, web pages."""

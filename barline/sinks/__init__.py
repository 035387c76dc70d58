from barline.sinks.writers import assert_unique, write_document, write_table, write_with_readback  # noqa: F401

"""Sources and sinks: text files, the snapshot store, tables derived for tests."""

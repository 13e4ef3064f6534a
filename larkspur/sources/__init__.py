"""Sources and sinks: message decoding, offset-addressed files, the lake table."""

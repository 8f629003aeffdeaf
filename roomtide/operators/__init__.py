"""DataFrame -> DataFrame operators; none of them runs Python per row."""

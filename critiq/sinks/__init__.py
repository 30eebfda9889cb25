"""Text renderings and writers (K1–K5)."""

from critiq.sinks.text import (  # noqa: F401
    render_best_block, render_best_line, render_delimited, render_key_value, render_report_lines, render_tsv,
    write_csv, write_lines, write_ordered_lines, write_report, write_tsv,
)

"""Reading: tables, watermarked batches, dated event files, text files, price ticks."""

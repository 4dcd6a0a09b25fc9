"""One import for the operators, by SURVEY §2 id.

    from docweave import api
    chunks = api.preprocess_job(content)
"""

from docweave.functions.metadata import (  # noqa: F401
    clean_meta_list,            # D3
    json_entries,               # typed metadata entries
    metadata_text_v1,           # D1 (B5 filter inside)
    metadata_text_v2,           # D2 (B5 filter inside)
)
from docweave.functions.text import (  # noqa: F401
    build_context,              # C5
    html_to_text,               # C1d
    nfc,                        # C1a
    normalize_text,             # C1
    pretokens,                  # C2 pieces
    slug_key,                   # C8 key
    title_name,                 # C8 name
    token_count,                # C2
    type_key,                   # C9
)
from docweave.operators.chunking import (  # noqa: F401
    chunk_records,              # C4
    chunk_recursive,            # C3
    chunk_recursive_native,     # C3
    chunk_window,               # C3, native variant
    embedding_records,          # C6
    embedding_update_records,   # C7
    split_recursive,            # C3 for one text
)
from docweave.operators.enrichment import (  # noqa: F401
    combine_summaries,          # D5, stored summaries
    enrich_embeddings,          # D4
    extend_summaries,           # D5, stored summaries
    merge_metadata_by_content,  # D5
    overlay_content_metadata,   # D6
    summarize_metadata,         # D5, stored summaries
    summarized_metadata,        # D5, stored summaries
)
from docweave.operators.lifecycle import (  # noqa: F401
    apply_embeddings,           # G4
    attachments,                # G6
    completed_at_provider,      # B3
    completed_contents,         # F1 (strict=True for the strict form)
    create_batches,             # G1
    mark_batch_complete,        # G2
    mark_content_complete,      # G5
    mark_in_batch,              # G3
    mark_processed,             # G7
    pending_batches,            # B2
    present_key,                # B4
    set_content_status,         # G8
)
from docweave.operators.tables import (  # noqa: F401
    allocate_ids,               # A8 ids
    append_rows,                # A8
    assign_batches,             # E1
    child_ids,                  # A3
    delete_by_ids,              # A11
    filter_table,               # A2
    lookup,                     # A1
    update_by_content,          # A10
    update_by_key,              # A9
    with_row_index,             # E1 numbering
)
from docweave.operators.tags import (  # noqa: F401
    embedding_tag_pairs,        # E5
    explode_keywords,           # E2
    new_content_tag_pairs,      # E6 (F2 inside)
    tags_get_or_create,         # E3
    types_get_or_create,        # E4
)
from docweave.plans.jobs import (  # noqa: F401
    complete_job,               # stage 3
    enrich_job,                 # stage 2
    nonempty_content,           # B1
    preprocess_job,             # stage 1
    write_outputs,
)
from docweave.sources.bucketed import write_bucketed  # noqa: F401  (targets of A9, A11, G*)
from docweave.sources.files import (  # noqa: F401
    embedding_requests,         # A7 lines
    read_embedding_output,      # A6
    read_embedding_output_table,  # A6b
    read_enrichment_output,     # A5
    read_tabular,               # A4
    write_embedding_requests,   # A7 sink
)
from docweave.streaming.completion import (  # noqa: F401
    completion_tables,          # S3: G2, G4, G5, G7 on the tables
    stream_completion,          # S3
)
from docweave.streaming.jobs import (  # noqa: F401
    stream_chunks,              # S1
    stream_enrichment,          # S2
)

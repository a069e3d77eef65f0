-- Publications and mean citation count per (publisher, type); the 20 largest groups.
-- Parameter: {publications} = silver publications.
SELECT publisher,
       publication_type,
       count(*) AS publication_count,
       avg(is_referenced_by_count) AS avg_citation_count
FROM {publications}
GROUP BY publisher, publication_type
ORDER BY publication_count DESC, publisher ASC NULLS LAST, publication_type ASC NULLS LAST
LIMIT 20

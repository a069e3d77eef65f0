-- Top authors by number of distinct publications, then by first-author count.
-- Only structured names count: a row whose given and family names are both missing or blank
-- has an empty display name and is left out (name-only records therefore never count).
-- Parameter: {authors} = silver publication authors.
SELECT author_name,
       count(DISTINCT doi) AS publication_count,
       count_if(sequence = 'first') AS first_author_count
FROM (
    SELECT doi, sequence, nullif(trim(concat_ws(' ', given_name, family_name)), '') AS author_name
    FROM {authors}
    WHERE given_name IS NOT NULL OR family_name IS NOT NULL  -- implied below; pushed to the scan
) AS a
WHERE author_name IS NOT NULL
GROUP BY author_name
ORDER BY publication_count DESC, first_author_count DESC, author_name ASC
LIMIT 20

-- Fixed values: the labels of the result.
-- Distinct assets per organisational unit.
WITH codes AS (
  SELECT DISTINCT upper(id) AS owner_key,
         concat_ws('/', coalesce(regexp_extract(direction, r'(?s).*\((.*)\)', 1), ''),
                        coalesce(regexp_extract(division, r'(?s).*\((.*)\)', 1), ''),
                        coalesce(regexp_extract(regroupement_unite, r'(?s).*\((.*)\)', 1), ''),
                        coalesce(regexp_extract(um, r'(?s).*\((.*)\)', 1), ''),
                        coalesce(regexp_extract(dum, r'(?s).*\((.*)\)', 1), ''),
                        coalesce(regexp_extract(code_moa, r'(?s).*\((.*)\)', 1), '')) AS maille
  FROM (SELECT * FROM people UNION ALL SELECT * FROM departments)
  WHERE id IS NOT NULL AND trim(id) <> ''
)
SELECT 'Nb postes' AS indicateur, 'Nb postes' AS indicateur_parent, coalesce(maille, '/////') AS maille,
       'groupes mailles direction/division/regroupement_unite/um/dum/code rc' AS maille_parent,
       count(DISTINCT tag) AS valeur
FROM assets LEFT JOIN codes ON owner_key = upper(owner_id)
GROUP BY coalesce(maille, '/////')

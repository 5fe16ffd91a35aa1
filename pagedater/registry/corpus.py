"""Adapter corpus: the ``documents`` table as wiki pages of every kind.

One SQL text that runs alike on Spark and on the checking engine. Every document
appears, with its whole text, as a scanned page, a stand-alone text, an author page
and a redirect, and gives one embedding page; every source gives an index page and
an embedding page of a book.
"""

CORPUS_SQL = """
select doc_id*10 as page_id,
       concat('Page:',source,'.djvu/',cast(doc_id as string)) as title,
       concat('<noinclude><pagequality level="',cast(doc_id%7%5 as string),'" user="u" /></noinclude>',text,
              ' {{Droite|{{sc|Fin}} de la page}} ''''''gras'''' <ref name="a">note</ref>') as text
from documents
union all
select doc_id*10+1, concat('Texte ',cast(doc_id as string)),
       concat('{{TextQuality|',case when doc_id%4=0 then 'Textes validés' else concat(cast((doc_id%4)*25-25 as string),'%') end,'}} ',text,
              '<!-- [[Catégorie:2018]] --> [[Auteur:A B|A B]] [[w:Exemple]] [[Fichier:f.jpg|vu par [[Auteur:C|C]] ici]]',
              ' {{Titre|{{lang|fr|{{sc|T}}}}|1700}} [[Catégorie:',cast(1450+doc_id%570 as string),
              ']] [[catégorie: Conte |c]] [[Catégorie:Domaine public en 2020]]',
              ' &eacute;t&#233;&#x20;&amp;lt; <nowiki>{{n}} [[Catégorie:1999]]</nowiki>')
from documents
union all
select min(doc_id)*10+2, concat('Livre:',source,'.djvu'),
       concat('{{:MediaWiki:Proofreadpage_index_template |Titre={{t|Annee=1700}} |Remarques=[[x|Annee=1710]] |Annee=',
              case when min(doc_id)%5=0 then 'MDCC' when min(doc_id)%2=0 then concat('{{a|{{b|',cast(1500+min(doc_id)*31%450 as string),'}}}}')
                   else concat('[[A|',cast(1500+min(doc_id)*31%450 as string),']]') end,
              ' |Publication=',case when min(doc_id)%5=0 then '' else concat(cast(1480+min(doc_id)*17%450 as string),'-',cast(1490+min(doc_id)*17%450 as string)) end,'}} {{autre|Annee=1720|Publication=1730}}')
from documents group by source
union all
select max(doc_id)*10+3, concat('Oeuvre ',source),
       concat('{{TextQuality|75%}} <pages index="',substr(source,1,4),'" from=1 to=3 />',
              case when max(doc_id)%5=0 then '' else concat(' [[Catégorie:',cast(1500+max(doc_id)%500 as string),']]') end)
from documents group by source
union all
select doc_id*10+4, concat('Chapitre ',cast(doc_id as string)),
       concat('{{page|',case when doc_id%2=0 then '24' else concat(source,'.djvu/',cast(doc_id as string)) end,
              '|num=4}} [[Category:',cast(1600+doc_id%300 as string),']]')
from documents
union all
select doc_id*10+5, concat('Auteur:',cast(doc_id as string)), text from documents
union all
select doc_id*10+6, concat('Renvoi ',cast(doc_id as string)),
       concat('#REDIRECTION [[Texte ',cast(doc_id as string),']] ',text) from documents
"""
